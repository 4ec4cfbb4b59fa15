"""File readers on written fixtures, with file splits forced small."""

import os

import pytest
from pyspark.sql import functions as F

from quire.sources import files as R
from quire.sources.sinks import label_run, write_run


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _write(tmp_path, name, text):
    p = os.path.join(tmp_path, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_vocab_last_duplicate_wins_and_line_zero_is_unknown(spark, tmp_path, small_splits):
    lines = ["utf8", "a", "b", " c ", "a"] + [f"w{i}" for i in range(40)]
    p = _write(tmp_path, "vocab.all", "\n".join(lines) + "\n")
    v = {r.term: r.term_id for r in R.read_vocab(spark, p).collect()}
    assert v["a"] == 4 and v["b"] == 2 and v["c"] == 3 and "utf8" not in v
    assert v["w39"] == 44 and len(v) == 43


def test_file_list_positions_across_splits(spark, tmp_path, small_splits):
    paths = [f"coll/dir{i % 3}/DOC_{i:05d}" for i in range(120)]
    text = "\n".join(paths[:50]) + "\n\n" + "\n".join(paths[50:100]) + "\n" + " ".join(paths[100:]) + "\n"
    p = _write(tmp_path, "file-list", text)
    df = R.read_file_list(spark, p)
    assert spark.read.text(p).rdd.getNumPartitions() > 10
    got = sorted((r.doc_id, r.path) for r in df.collect())
    assert got == list(enumerate(paths))


def test_inverted_file_cut_by_splits(spark, tmp_path, small_splits):
    blocks, want = [], []
    for t in range(1, 40):
        t2 = -1 if t % 3 else t + 1
        docs = list(range(t % 7 + 1))
        blocks.append(f"{t} {t2} {len(docs)}")
        for d in docs:
            blocks.append(f"{d} {t * 10 + d}")
            want.append((1 if t2 == -1 else 2, t, t2, d, t * 10 + d, len(docs)))
    p = _write(tmp_path, "inverted-file", "\n".join(blocks) + "\n")
    assert spark.read.text(p).rdd.getNumPartitions() > 10
    post = R.read_inverted_file(spark, p)
    got = sorted(tuple(r) for r in post.select(*R.POSTING_COLS).collect())
    assert got == sorted(want)
    assert R.inverted_file_errors(post).count() == 0


def test_inverted_file_count_check(spark, tmp_path):
    p = _write(tmp_path, "inverted-file", "1 -1 3\n0 2\n1 1\n")
    errs = R.inverted_file_errors(R.read_inverted_file(spark, p)).collect()
    assert [e.error for e in errs] == ["header count differs"]


def test_doc_lengths(spark, tmp_path):
    p = _write(tmp_path, "lens", "5\n7 9\n\n11\n")
    got = sorted(tuple(r) for r in R.read_doc_lengths(spark, p).collect())
    assert got == [(0, 5), (1, 7), (2, 9), (3, 11)]


TOPICS = """<?xml version="1.0" encoding="UTF-8"?>
<xml>
<topic>
<number>SETATopicXY001 </number>
<title>ab</title>
<question>
cd，e
</question>
<narrative>x</narrative>
<concepts>
ab、cd。
</concepts>
</topic>
<topic>
<number>SETATopicXY002</number>
<title>zz</title>
</topic>
</xml>
"""


def test_topics_xml(spark, tmp_path):
    p = _write(tmp_path, "topics.xml", TOPICS)
    batch, numbers = R.topic_batch_from_xml(spark, p, "char")
    assert sorted((r.topic_id, r.topic_no) for r in numbers.collect()) == [(0, "001"), (1, "002")]
    terms = {(r.topic_id, r.n, r.t1, r.t2): r.qtf for r in batch.terms().collect()}
    assert terms[(0, 2, "d", "e")] == 1           # deleted mark bridges d-e
    assert (0, 2, "b", "c") not in terms          # fields and concepts never bridge
    assert terms[(0, 1, "a", "")] == 2            # title + concept, repeats kept
    assert terms[(0, 2, "a", "b")] == 2
    assert batch.ids.count() == 2
    assert sorted(r.topic_id for r in batch.grams.select("topic_id").distinct().collect()) == [0, 1]


def test_doc_xml(spark, tmp_path):
    p = _write(tmp_path, "d.xml", "<root><doc><title>t，i</title><text><p>ab</p><p>c\nd</p></text></doc></root>")
    r = R.read_doc_xml(spark, p).first()
    assert r.title == "t，i" and r.paragraphs == ["ab", "c\nd"]


def test_qrels_and_run_writing(spark, tmp_path):
    p = _write(tmp_path, "ans", "001 news_a_17\n001 news_b_4\n002 x\n")
    assert R.read_qrels(spark, p).count() == 3
    run = spark.createDataFrame([(0, 10, 1), (0, 11, 2), (1, 10, 1)], "topic_id long, doc_id long, rank int")
    numbers = spark.createDataFrame([(0, "T001"), (1, "T002")], "topic_id long, number string")
    paths = spark.createDataFrame([(10, "a/B/DOC10"), (11, "a/c/doc11"), (12, "x")], "doc_id long, path string")
    lab = sorted(tuple(r) for r in label_run(run, numbers, paths).select("topic_no", "rank", "doc_key").collect())
    assert lab == [("001", 1, "doc10"), ("001", 2, "doc11"), ("002", 1, "doc10")]
    out = os.path.join(tmp_path, "run")
    write_run(run, numbers, paths, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part-"))
    assert text == "001 doc10\n001 doc11\n002 doc10\n"
    with pytest.raises(Exception):
        write_run(run, numbers, paths, out)  # never overwrites
    with pytest.raises(ValueError):
        write_run(run, numbers.where(F.col("topic_id") == 0), paths, os.path.join(tmp_path, "r2"))


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        R.read_vocab(spark, os.path.join(tmp_path, "nope")).collect()
