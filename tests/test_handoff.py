"""The hand-off files, topics of any root, vocabulary ids over documents, and
the measures, each against what was written or a plain Python version."""

import os

import pytest

from quire import TopicBatch
from quire.operators.evaluation import average_precision, containing
from quire.operators.index import vocab_postings
from quire.operators.ranking import ranked_with_zeros
from quire.sources import files as R
from quire.sources import handoff as H


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _file(tmp_path, name, text):
    path = os.path.join(tmp_path, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_rank_file_round_trip(spark, tmp_path, small_splits):
    run = spark.createDataFrame([(t, d, r) for t in (3, 5, 9) for r, d in enumerate(range(40 - t), 1)], "topic_id long, doc_id long, rank int")
    ids = spark.createDataFrame([(3,), (5,), (7,), (9,)], "topic_id long")          # topic 7 has no documents
    paths = spark.createDataFrame([(d, f"Coll/A{d:03d}") for d in range(60)], "doc_id long, path string")
    out = os.path.join(tmp_path, "ranks")
    H.write_rank_file(run, ids, paths, out)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        H.write_rank_file(run, ids, paths, out)
    got = sorted((r["list"], r["rank"], r["path"]) for r in H.read_rank_file(spark, out).collect())
    assert got == sorted((i, r, f"Coll/A{r - 1:03d}") for i, t in ((0, 3), (1, 5), (3, 9)) for r in range(1, 41 - t))
    numbers = _file(tmp_path, "numbers", "XX003\n\nXX005\n \nXX007\nXX009\n")
    labelled = {(r["list"], r["topic_no"], r["rank"], r["doc_key"]) for r in H.label_rank_file(spark, out, numbers).collect()}
    assert (3, "009", 2, "a001") in labelled and len(labelled) == len(got)
    with pytest.raises(ValueError, match="4 ranked lists and 1 topic numbers"):
        H.label_rank_file(spark, out, _file(tmp_path, "few", "XX003\n"))
    with pytest.raises(ValueError, match="not ended"):
        H.read_rank_file(spark, _file(tmp_path, "cut", "a\nb\n********\nc\n"))


def test_parsed_topics_round_trip(spark, tmp_path, small_splits):
    grams = [(t, "0", 1, 10 + i % 4, -1) for t in (0, 2, 3, 4) for i in range(3 * t + 1)] + [(t, "0", 2, i, i + t) for t in (0, 3, 4) for i in range(5)]
    batch = TopicBatch(spark.range(6).selectExpr("id AS topic_id"), spark.createDataFrame(grams, "topic_id long, field string, n int, t1 int, t2 int"))
    out = os.path.join(tmp_path, "topics")
    H.write_topic_terms(batch, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part-"))
    assert text.startswith("6\n1 5\n") and len(text) > 128
    back = H.read_topic_terms(spark, out)
    assert sorted(map(tuple, back.terms().collect())) == sorted(map(tuple, batch.terms().collect()))
    assert sorted(r["topic_id"] for r in back.ids.collect()) == list(range(6))
    with pytest.raises(ValueError, match="3 topics announced"):
        H.read_topic_terms(spark, _file(tmp_path, "early", "3\n1 0\n7\n1 1\n8\n"))
    one = H.read_topic_terms(spark, _file(tmp_path, "one", "1\n2 1\n7\n8 7 8\n"))        # line ends mean nothing
    assert sorted(map(tuple, one.terms().collect())) == [(0, 1, 7, -1, 1), (0, 1, 8, -1, 1), (0, 2, 7, 8, 1)]


def test_topics_of_any_root(spark, tmp_path):
    one = "<?xml version='1.0'?>\n<!-- <topic> -->\n<topics>\n<topic><number>XX001</number><title>ab</title></topic>\n" \
          "<set><topic><number>XX009</number></topic></set></topics>"
    topics = R.read_topics(spark, _file(tmp_path, "one.xml", one))
    assert [(r.topic_pos, r.number) for r in topics.collect()] == [(0, "XX001")]
    with pytest.raises(ValueError, match="has no topic"):
        R.read_topics(spark, _file(tmp_path, "none.xml", "<topics><other/></topics>"))
    with pytest.raises(ValueError, match="one root element"):
        R.read_topics(spark, _file(tmp_path, "text", "no tag at all"))


def test_vocabulary_ids_break_at_unknown_words(spark):
    docs = spark.createDataFrame([(1, "a b x a b c"), (2, "x x"), (3, None), (4, "c c c")], "doc_id long, text string")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("x", 0)], "term string, term_id int")
    got = sorted(tuple(r) for r in vocab_postings(docs, vocab).collect())
    assert got == [(1, 1, -1, 1, 2), (1, 2, -1, 1, 2), (1, 3, -1, 1, 1), (1, 3, -1, 4, 3), (2, 1, 2, 1, 2), (2, 2, 3, 1, 1), (2, 3, 3, 4, 2)]


def test_average_precision_by_hand(spark):
    run = spark.createDataFrame([(1, d, r) for r, d in enumerate([5, 6, 7, 8], 1)] + [(2, 5, 1)], "topic_id long, doc_id long, rank int")
    judged = spark.createDataFrame([(1, 5), (1, 7), (1, 99), (1, 7), (2, 6), (3, 1)], "topic_id long, doc_id long")
    got = {r["topic_id"]: tuple(r)[1:] for r in average_precision(run, judged, 2).collect()}
    ap = (1 / 1 + 2 / 3) / 3
    want = {1: (3, 1, 0.5, 1 / 3, ap, ap / 3), 2: (1, 0, 0.0, 0.0, 0.0, ap / 3), 3: (1, 0, 0.0, 0.0, 0.0, ap / 3)}
    assert got.keys() == want.keys() and all(got[t] == pytest.approx(want[t]) for t in want)


def test_containment_finds_every_document(spark):
    texts = ["say the quick brown fox here", "xthe quick brown foxy", "the quick brown", None, "", "THE QUICK BROWN FOX", "the quick brown fox"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    topics = spark.createDataFrame([(1, "the quick brown fox"), (2, "never found at all"), (3, None)], "topic_id long, text string")
    assert sorted(tuple(r) for r in containing(docs, topics).collect()) == [(1, 0), (1, 1), (1, 6)]


@pytest.mark.parametrize("n", [40, 400])
def test_zero_fill_jobs_do_not_grow(spark, n):
    """All documents matched below 0 but three; as many jobs for ten times the documents."""
    gaps = {3, n - 2, n // 2}
    df = spark.createDataFrame([(1, d, -1.0 - d) for d in range(n) if d not in gaps], "topic_id long, doc_id long, score double")
    listed = spark.createDataFrame([(d,) for d in range(n)], "doc_id long")
    tracker, group = spark.sparkContext.statusTracker(), f"zero-fill-{n}"
    spark.sparkContext.setJobGroup(group, group)
    got = [r["doc_id"] for r in ranked_with_zeros(df, spark.createDataFrame([(1,)], "topic_id long"), listed, 5, False).orderBy("rank").collect()]
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == [*sorted(gaps), 0, 1]
    assert jobs <= 40
