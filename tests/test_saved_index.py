"""A saved index: the same ranking by block bounds, from fewer postings, and
weights without a join."""

import os
import random

import pytest

import quire.operators.index as index_module
from quire import TopicBatch, search
from quire.operators.index import Index
from quire.plans.search import Search


@pytest.fixture
def collection(spark, tmp_path, monkeypatch):
    """300 documents of common words; two stretches of them hold the topics' words often."""
    monkeypatch.setattr(index_module, "BLOCK_DOCS", 10)
    rnd = random.Random(4)
    common = [f"c{i}" for i in range(12)]
    rows = []
    for d in range(300):
        words = [rnd.choice(common) for _ in range(30)] + (["alpha", "beta"] if d % 5 == 0 else [])
        if 100 <= d < 120 or 250 <= d < 260:
            words += ["alpha beta"] * rnd.randint(3, 9)
        rows.append((d * 7, " ".join(words)))
    docs = spark.createDataFrame(rows + [(9999, None)], "doc_id long, text string")
    topics = spark.createDataFrame([(1, "alpha beta"), (2, "c1 c2 alpha"), (3, "nowhere"), (4, "c3 beta c4 c5")], "id long, text string")
    path = os.path.join(tmp_path, "index")
    Index.from_documents(docs).save(path)
    return docs, TopicBatch.from_table(topics, "id", "text"), Index.load(spark, path)


@pytest.mark.parametrize("k", [3, 25, 400])
def test_block_bounds_keep_the_ranking(collection, k):
    docs, topics, loaded = collection
    want = sorted(map(tuple, search(docs, topics, k=k).collect()))
    assert sorted(map(tuple, search(loaded, topics, k=k).collect())) == want
    assert sorted(map(tuple, search(loaded, topics, k=k, feedback=True).collect())) == sorted(map(tuple, search(docs, topics, k=k, feedback=True).collect()))


def test_block_bounds_read_fewer_postings(collection):
    _, topics, loaded = collection
    s = Search(loaded, topics)
    _, open_blocks = s.block_plan(5)
    bounds = s.bounds()
    only = lambda df: df.where("topic_id = 1")
    assert only(open_blocks).count() + 1 < only(bounds).count() / 2
    assert s.postings_of(only(open_blocks))[0].count() < s.postings_of(only(bounds))[0].count() / 2


def test_weights_of_a_saved_index_need_no_exchange(collection):
    docs, _, loaded = collection
    assert "Exchange" not in loaded.postings_with_df()._jdf.queryExecution().executedPlan().toString()
    want = {tuple(r) for r in Index.from_documents(docs).materialized().postings_with_df().select("n", "t1", "t2", "doc_id", "tf", "df").collect()}
    assert {tuple(r) for r in loaded.postings_with_df().select("n", "t1", "t2", "doc_id", "tf", "df").collect()} == want
