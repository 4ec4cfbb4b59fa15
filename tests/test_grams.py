"""Word grams counted in Arrow batches, and the cosine ranking that reads them."""

import random
from collections import Counter
from dataclasses import replace

import pytest

from quire import TopicBatch
from quire.functions.text import WORD
from quire.operators import grams, products
from quire.operators import scoring as S
from quire.operators.index import Index, document_sequences
from quire.operators.ranking import top_k
from quire.plans.search import Search

TEXTS = ["", None, "one", "a b a b a", "a", "b", "Ünïcode ÉTÉ été", "x² ⅷ٣ ǅ \U0001d7d8\U00020000z", "word-word's_word", "İstanbul ΣΑΣ", "  ", "é", "-",
         "日本語、テキスト", "áb ‍ c", " ".join(f"w{i % 7}" for i in range(60))]


def _docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a b c"), (None, "a b"), (None, "b")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def _brute(docs):
    """Grams of the words that Spark's own expressions cut."""
    counts = Counter()
    for r in document_sequences(docs, WORD).collect():
        for g in [(0, "", "")] + [(1, w, "") for w in r.seq] + [(2, *p) for p in zip(r.seq, r.seq[1:])]:
            counts[(*g, r.doc_id, r.dl)] += 1
    return {(*k, n) for k, n in counts.items()}


@pytest.mark.parametrize("piece", [40, 1 << 21])
def test_grams_are_those_of_the_tokenizer(spark, monkeypatch, piece):
    monkeypatch.setattr(grams, "PIECE_BYTES", piece)
    docs = _docs(spark)
    got = Index.from_documents(docs).postings_all.select("n", "t1", "t2", "doc_id", "dl", "tf").collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == _brute(docs)


def test_word_characters_are_those_of_the_pattern(spark):
    marked = grams.np.unpackbits(grams.word_characters(spark)).astype(bool)
    assert [p for p in range(0x80) if marked[p]] == [p for p in range(0x80) if chr(p).isalnum()]
    assert all(marked[ord(c)] for c in "é²ⅷ٣ǅ日\U0001d7d8\U00020000") and not any(marked[ord(c)] for c in "，、\u200d\u0301\U0001f600\ufffd")


@pytest.mark.parametrize("terms", [[(1, "a", ""), (2, "a", "b"), (2, "w0", "w1")], [(1, "zzz", "")]])
def test_wanted_terms_only(spark, terms):
    docs = _docs(spark)
    keep = spark.createDataFrame(terms, "n int, t1 string, t2 string")
    got = Index.from_documents(docs, restrict_to=keep).postings_all
    assert "Exchange hashpartitioning(doc_id, dl" not in Index.from_documents(docs.where("doc_id > 3"), restrict_to=keep).postings_all._jdf.queryExecution().toString()
    want = {r for r in _brute(docs) if r[0] == 0 or r[:3] in terms}
    assert set(map(tuple, got.select("n", "t1", "t2", "doc_id", "dl", "tf").collect())) == want


def _repeated(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(25)]
    text = lambda most: " ".join(["all", *rnd.choices(words, [1 / (i + 1) for i in range(25)], k=rnd.randint(0, most))])
    rows = [(d, text(30)) for d in range(70)]
    rows += [rows[5], rows[5], (7, text(60)), (7, text(5)), (None, "w1 w2 w3"), (None, "w2"), (200, None), (201, "all")]
    topics = [(q, text(6)) for q in range(6)] + [(6, None), (7, "all"), (8, "w24 all"), (9, "unseen")]
    topics = TopicBatch.from_table(spark.createDataFrame(topics, "topic_id long, text string"), "topic_id", "text")
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3), topics


def test_norms_from_texts_equal_those_of_postings(spark):
    """No posting is written and no word moves; rows of one id with equal and other lengths."""
    index = Index.from_documents(_repeated(spark)[0])
    norms = index.doc_norms()
    assert "t1" not in norms._jdf.queryExecution().optimizedPlan().toString()
    rows = lambda df: sorted((str(r.doc_id), r.n, round(r.l2, 9)) for r in df.collect())
    assert rows(norms) == rows(replace(index, texts=None).doc_norms())


def test_cosine_equals_row_sums(spark, monkeypatch):
    monkeypatch.setattr(products, "CELLS", 40)
    docs, topics = _repeated(spark)
    full = replace(Index.from_documents(docs, orders=(1,)), texts=None).materialized()
    norms = full.doc_norms().checkpoint()
    rows = Search(full, topics)
    want = top_k(S.cosine_scores(rows.contributions(factors=S.cosine_factors(rows.qstats(), rows.n_docs)), norms), 60).orderBy("topic_id", "rank").collect()
    s = Search(docs, topics, orders=(1,))
    for k in (3, 60):
        assert s.ranked_cosine(norms, k).orderBy("topic_id", "rank").collect() == [r for r in want if r["rank"] <= k]
    assert any(r.score == 0 for r in want) and any(r.score > 0 for r in want)
