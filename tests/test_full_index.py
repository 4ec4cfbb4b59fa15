"""The full index: grams are counted inside the row, df meets the postings in one exchange."""

import re
from collections import Counter

from quire.operators.index import Index, vocab_postings

ROWS = [(1, "a b a b a"), (2, "b c"), (2, "b c"), (2, "c"), (None, "a a"), (None, "a a"), (3, None), (4, "ab a b ab \U00020000x")]


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        grams = [(1, w, "") for w in words] + [(2, *p) for p in zip(words, words[1:])]
        counts.update((*g, doc, len(words)) for g in grams)
    return {(*key, tf) for key, tf in counts.items()}


def postings(spark, rows):
    return Index.from_documents(spark.createDataFrame(rows, "doc_id long, text string")).postings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_of_repeated_and_null_ids_are_added_up(spark):
    got = postings(spark, ROWS).select("n", "t1", "t2", "doc_id", "dl", "tf").collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == brute(ROWS)


def test_no_gram_is_shuffled(spark):
    single = [r for r in ROWS if r[0] in (1, 3, 4)]
    assert "Exchange" not in plan(postings(spark, single))


def test_df_meets_the_postings_in_one_exchange(spark, monkeypatch):
    monkeypatch.setattr("quire.operators.index.HOT_TERMS", 1)
    index = Index.from_documents(spark.createDataFrame(ROWS, "doc_id long, text string")).materialized()
    joined = index.postings_with_df()
    assert "SortMergeJoin" not in plan(joined)
    want = Counter(p[:3] for p in brute(ROWS))
    got = joined.select("n", "t1", "t2", "doc_id", "dl", "tf", "df").collect()
    assert {tuple(r)[:6] for r in got} == brute(ROWS) and len(got) == len(brute(ROWS))
    assert all(r["df"] == want[(r["n"], r["t1"], r["t2"])] for r in got)


def test_vocabulary_ids_come_to_the_grams(spark):
    docs = spark.createDataFrame([(1, "a b c a b"), (2, "b x a"), (3, None)], "doc_id long, text string")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 0)], "term string, term_id int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = vocab_postings(docs, vocab)
        assert "Exchange hashpartitioning" not in plan(ids)
        got = set(map(tuple, ids.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {(1, 1, -1, 1, 2), (1, 2, -1, 1, 2), (1, 2, -1, 2, 1), (1, 1, -1, 2, 1), (2, 1, 2, 1, 2)}


def test_saved_terms_and_blocks_are_those_of_the_postings(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("quire.operators.index.HOT_TERMS", 1)
    monkeypatch.setattr("quire.operators.index.BLOCK_DOCS", 2)
    index = Index.from_documents(spark.createDataFrame(ROWS, "doc_id long, text string"))
    path = str(tmp_path / "index")
    index.save(path)
    loaded = Index.load(spark, path)
    assert sorted(map(tuple, loaded.terms.collect())) == sorted(map(tuple, index.terms.collect()))
    saved = loaded.postings_all.collect()
    assert sorted((r["n"], r["t1"], r["t2"], r["doc_id"] or 0, r["dl"], r["tf"]) for r in saved) == sorted((*k[:3], k[3] or 0, *k[4:]) for k in brute(ROWS))
    n_docs, total = loaded.stats
    top = {}
    for r in saved:
        norm = 0.3 + 0.7 * r["dl"] / (total // n_docs)
        if r["block"] is not None:
            key = (r["n"], r["t1"], r["t2"], r["block"])
            top[key] = max(top.get(key, 0), r["tf"] / norm ** 2)
    blocks = {tuple(r)[:4]: r["top"] for r in loaded.blocks.collect()}
    assert len(blocks) == loaded.blocks.count() and blocks.keys() == top.keys()
    assert all(abs(blocks[k] - top[k]) < 1e-9 for k in top)


def test_packed_postings_have_their_df(spark, monkeypatch):
    """Blocks and parts of a few rows, null ids and words, counts of 0: the rows of a
    window over the terms; what moves is blocks."""
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from quire.operators import packed

    monkeypatch.setattr(packed, "BLOCK_ROWS", 50)
    monkeypatch.setattr(packed, "PART_ROWS", 40)
    monkeypatch.setattr(packed, "OUT_ROWS", 7)
    rnd = random.Random(4)
    words = ["a", "b", "", "çé", None, "long word"]
    rows = [(rnd.choice([1, 2]), rnd.choice(words), rnd.choice(words[:3]), rnd.choice([None, 1, 2, 3]), rnd.choice([0, 1, 5, None]), 9) for _ in range(400)]
    postings = spark.createDataFrame(rows, "n int, t1 string, t2 string, doc_id long, tf long, dl long").repartition(3)
    got = packed.with_df(postings, ["n", "t1", "t2"])
    want = postings.withColumn("df", F.count(F.when(F.col("tf") > 0, 1)).over(Window.partitionBy("n", "t1", "t2")))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert packed.with_df(postings.limit(0), ["n", "t1", "t2"]).isEmpty()
    docs = spark.createDataFrame([(i, f"alpha w{i % 5} beta w{i % 3}") for i in range(20)], "doc_id long, text string")
    from quire.operators.index import Index
    plan = Index.from_documents(docs).materialized().postings_with_df()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(part" in plan and "Window" not in plan


def test_written_tables_free_their_shuffle_files(spark):
    import time

    from pyspark.sql import functions as F
    from quire.operators.written import written

    status = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    held = lambda: {b.name() for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(status.getAllBlocks()) if b.isShuffle()}
    before = held()
    table = written(spark.range(1000).repartition(5, F.col("id")), "t")
    end = time.time() + 20
    while held() - before and time.time() < end:
        time.sleep(0.2)
    assert not held() - before and table.count() == 1000
