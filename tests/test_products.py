"""Scores by block products against sums over matched rows."""

import random

import pytest
from pyspark.sql import functions as F

from quire import TopicBatch
from quire.functions import weights as W
from quire.operators import products
from quire.operators import scoring as S
from quire.operators.ranking import ranked_with_zeros
from quire.plans.search import Search


def _search(spark, seed=3, n_docs=120, n_topics=9):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    text = lambda most: " ".join(rnd.choices(words, weights, k=rnd.randint(0, most)))
    rows = [(d, text(40)) for d in range(n_docs)]
    # an id that comes again: the same text, another length, and no id at all
    rows += [rows[5], (7, text(60)), (7, text(5)), (None, "w1 w2 w3"), (None, "w2"), (200, None)]
    topics = [(q, text(12)) for q in range(n_topics)] + [(n_topics, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return Search(docs, TopicBatch.from_table(spark.createDataFrame(topics, "topic_id long, text string"), "topic_id", "text"))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("gain, normed", [(0, True), (64, True), (1 << 40, False)])
def test_ranked_equals_row_sums(spark, monkeypatch, gain, normed):
    # blocks of few documents, two slices of topics, pieces of few matches and terms
    for name, value in (("CELLS", 40), ("SLICE_TOPICS", 5), ("MATCHES", 30), ("DENSE_TERMS", 3), ("DENSE_GAIN", gain)):
        monkeypatch.setattr(products, name, value)
    s = _search(spark)
    contrib = s.contributions(nonzero=True)
    rows = s.scores(contrib) if normed else S.sum_scores(contrib)
    want = ranked_with_zeros(rows, s.topics.ids, s.index.listed, 6, True)
    assert _rows(s.ranked(s.factors(nonzero=True), 6, normed)) == _rows(want)


def test_a_task_gives_few_rows_of_many_matches(spark, monkeypatch):
    monkeypatch.setattr(products, "CELLS", 10 * 20)
    s = _search(spark, n_docs=3000)
    norm = W.length_norm(F.col("dl"), s.avgdl)
    found = products.best_scores(s.index.postings_all, s.factors(nonzero=True), norm * norm, 3)
    assert found.count() * 4 < s.scores(s.contributions(nonzero=True)).count()


def test_no_common_term(spark):
    docs = spark.createDataFrame([(1, "alpha"), (2, "beta")], "doc_id long, text string")
    topics = spark.createDataFrame([(1, "gamma"), (2, "delta")], "topic_id long, text string")
    s = Search(docs, TopicBatch.from_table(topics, "topic_id", "text"))
    assert _rows(s.run(1)) == [(1, 1, 0.0, 1), (2, 1, 0.0, 1)]


def test_slices_are_taken_in_turn(spark, monkeypatch):
    """Rows do not depend on the slices, and no plan holds more than ``MOST_HELD`` of them."""
    from pyspark.sql import functions as F
    from quire import TopicBatch, search
    from quire.operators import bounded, products

    small = spark.range(40).select(F.col("id").cast("string").alias("key"))
    joined = bounded.sliced_join(spark.range(200).select((F.col("id") % 60).cast("string").alias("key")), small, ["key"], 7)
    assert joined.count() == 40 * 3 + 20 and joined._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 0
    docs = spark.createDataFrame([(i, f"alpha w{i % 5} beta w{i % 3}") for i in range(20)], "doc_id long, text string")
    topics = TopicBatch.from_table(spark.createDataFrame([(t, f"alpha w{t} w{t + 1} beta") for t in range(5)], "id long, text string"), "id", "text")
    want = sorted(map(tuple, search(docs, topics, k=5).collect()))
    monkeypatch.setattr(products, "SLICE_TOPICS", 1)
    monkeypatch.setattr(products, "MOST_SLICES", 2)
    spark.conf.set("quire.broadcast.maxBytes", "400")
    try:
        assert sorted(map(tuple, search(docs, topics, k=5).collect())) == want
    finally:
        spark.conf.unset("quire.broadcast.maxBytes")
