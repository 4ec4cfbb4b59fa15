"""The path from files to a written run, over folders of part files, and the
failures of run labelling."""

import math
import os

import pytest
from pyspark.sql import functions as F

from quire.operators.index import Index
from quire.operators.ranking import ranked_with_zeros
from quire.plans.files import index_from_files, run_from_files
from quire.sources import files as R
from quire.sources.sinks import label_run, write_run


def _folder(tmp_path, name, parts):
    d = os.path.join(tmp_path, name)
    os.makedirs(d)
    for i, text in enumerate(parts):
        with open(os.path.join(d, f"part-{i:05d}"), "w", encoding="utf-8") as f:
            f.write(text)
    return d


def test_positions_run_on_over_part_files(spark, tmp_path):
    names = [f"c/d{i:03d}" for i in range(60)]
    files = _folder(tmp_path, "list", ["\n".join(names[:25]) + "\n", "\n".join(names[25:]) + "\n"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        assert sorted((r.doc_id, r.path) for r in R.read_file_list(spark, files).collect()) == list(enumerate(names))
        lens = _folder(tmp_path, "lens", ["5 6\n", "7\n"])
        assert sorted(tuple(r) for r in R.read_doc_lengths(spark, lens).collect()) == [(0, 5), (1, 6), (2, 7)]
        vocab = _folder(tmp_path, "vocab", ["utf8\na\n", "b\n"])
        assert {r.term: r.term_id for r in R.read_vocab(spark, vocab).collect()} == {"a": 1, "b": 2}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


TOPIC = "<topic><number>XX{0}</number><title>{1}</title>{2}</topic>"


def test_topics_are_root_children_with_repeated_fields(spark, tmp_path):
    one = "<xml>" + TOPIC.format("001", "ab", "<title>bc</title>") + "<group>" + TOPIC.format("009", "zz", "") + "</group></xml>"
    two = "<xml>" + TOPIC.format("002", "c", "") + "</xml>"
    topics = R.read_topics(spark, _folder(tmp_path, "t", [one, two]))
    assert sorted((r.topic_pos, r.number) for r in topics.collect()) == [(0, "XX001"), (1, "XX002")]
    fields = {(r.topic_id, r.text) for r in R.topic_fields(topics).where("field like 'title%'").collect()}
    assert fields == {(0, "ab"), (0, "bc"), (1, "c")}


def test_run_from_files(spark, tmp_path):
    # vocabulary a=1 b=2 c=3; x is unknown and breaks the bigram b-c
    vocab = _folder(tmp_path, "vocab", ["enc\na\nb\nc\n"])
    files = _folder(tmp_path, "files", ["p/D0\np/D1\n", "p/D2\np/D3\n"])
    # the header says 2 documents for a, one posting is there: df stays 2
    inverted = _folder(tmp_path, "inv", ["1 -1 2\n0 3\n2 -1 1\n1 2\n3 -1 1\n2 1\n", "2 3 1\n1 1\n"])
    topics = _folder(tmp_path, "topics", ["<xml>" + TOPIC.format("001", "abxc", "") + TOPIC.format("002", "bc", "") + "</xml>"])
    with pytest.warns(UserWarning, match="header count differs"):
        index = index_from_files(spark, files, inverted)
    assert {(r.t1, r.t2): r.df for r in index.terms.collect()} == {(1, -1): 2, (2, -1): 1, (3, -1): 1, (2, 3): 1}
    out = os.path.join(tmp_path, "run")
    with pytest.warns(UserWarning):
        run_from_files(spark, vocab, files, inverted, topics, out, k=2)
    lines = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part-")).split("\n")
    # by hand: lengths 3 2 1 0, avgdl 6 // 4 = 1. Topic 001 holds a, b, c; b and c are in both topics (weight 0),
    # so a alone counts, found in D0. Topic 002 holds the bigram b-c, found in D1.
    assert math.log2(4 / 2) > 0
    assert lines[:-1] == ["001 d0", "001 d1", "002 d1", "002 d0"]


def test_labelling_fails_on_gaps(spark, tmp_path):
    run = spark.createDataFrame([(0, 10, 1), (0, 11, 2), (1, 10, 1)], "topic_id long, doc_id long, rank int")
    numbers = spark.createDataFrame([(0, "T001"), (1, "T002")], "topic_id long, number string")
    paths = spark.createDataFrame([(10, "a/D10"), (11, "a/D11")], "doc_id long, path string")
    assert label_run(run, numbers, paths).count() == 3
    with pytest.raises(ValueError, match="0 ranked topics without a number and 1 ranked documents"):
        label_run(run, numbers, paths.where("doc_id = 10"))
    with pytest.raises(ValueError, match="1 ranked topics without a number"):
        write_run(run, numbers.where("topic_id = 0"), paths, os.path.join(tmp_path, "r1"))
    with pytest.raises(ValueError, match="topic numbers stand for more"):
        label_run(run, numbers.withColumn("number", F.lit("T001")), paths)
    with pytest.raises(ValueError, match="paths stand for more"):
        label_run(run, numbers, paths.withColumn("path", F.lit("a/same")))


@pytest.mark.parametrize("k", [1, 3, 7, 40])
def test_zero_fill_with_negative_scores(spark, k):
    # topic 1 matches most documents below 0, topic 2 none, topic 3 some above and some below
    docs = list(range(30))
    scores = {(1, d): -1.0 - d for d in docs if d != 20} | {(3, d): (0.5 if d % 3 else -0.5) for d in docs[:12]}
    df = spark.createDataFrame([(t, d, s) for (t, d), s in scores.items()], "topic_id long, doc_id long, score double")
    topics = spark.createDataFrame([(1,), (2,), (3,)], "topic_id long")
    listed = spark.createDataFrame([(d,) for d in docs], "doc_id long")
    got = {}
    for r in sorted(ranked_with_zeros(df, topics, listed, k, False).collect(), key=lambda r: r.rank):
        got.setdefault(r.topic_id, []).append(r.doc_id)
    want = {t: sorted(docs, key=lambda d: (-scores.get((t, d), 0.0), d))[:k] for t in (1, 2, 3)}
    assert got == want


def test_document_lengths_from_xml(spark, tmp_path):
    d = _folder(tmp_path, "x", ["<r><doc><title>ab</title><text><p>c d</p><p>e</p></text></doc></r>"])
    r = R.doc_xml_lengths(R.read_doc_xml(spark, d), d).first()
    assert r.path == "part-00000" and r.doc_len == r.title_len + r.text_len and r.title_len == 2


def test_plan_shape_and_rows_do_not_depend_on_the_bound(spark):
    from quire import TopicBatch, search
    docs = spark.createDataFrame([(i, f"alpha w{i % 5} beta w{i % 3}") for i in range(20)], "doc_id long, text string")
    topics = TopicBatch.from_table(spark.createDataFrame([(1, "alpha w1 beta"), (2, "w2 w3")], "id long, text string"), "id", "text")
    want = sorted(map(tuple, search(docs, topics, k=5, feedback=True).collect()))
    spark.conf.set("quire.broadcast.maxBytes", "900")
    try:
        assert sorted(map(tuple, search(docs, topics, k=5, feedback=True).collect())) == want
        # grams meet the terms by broadcast and move by document only
        plan = Index.from_documents(docs, restrict_to=topics.terms()).postings_all._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning(doc_id" in plan
    finally:
        spark.conf.unset("quire.broadcast.maxBytes")


def test_profiles_must_agree(spark):
    from quire import TopicBatch, search
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    topics = TopicBatch.from_table(docs, "doc_id", "text")
    with pytest.raises(ValueError, match="profile"):
        search(docs, topics, profile="char")
