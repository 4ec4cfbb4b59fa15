"""The registered query set: one callable per operator of the model, each
reading the driver's tables in full and running the library's operators.

Stand-ins for inputs the driver tables lack (a document path list, topic
number strings, a vocabulary) are derived from the tables in the schema the
operator expects; the operators themselves run unchanged on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions import weights as W
from quire.operators import scoring as S
from quire.operators.index import Index, vocab_postings
from quire.operators.topics import (TopicBatch, fields_from_table, field_grams, split_concepts,
                                    vocab_grams, vocab_sequence)
from quire.operators.evaluation import average_precision, containing
from quire.operators.written import written
from quire.plans.search import Search, search, search_legacy
from quire.sources.positional import ordered_ids
from quire.sources.sinks import label_run
from quire.sources.tables import table

K = 100          # documents per topic in the full searches
TOPK_K = 10      # the plain top-k operator
CUTOFF = 10      # precision and recall are taken at this rank
LATIN_CONCEPT_DELIMITER = ","   # concept separator used for the Latin-script topics

Query = Callable[[SparkSession, str], DataFrame]


# ---- inputs --------------------------------------------------------------

def _docs(spark, sf) -> DataFrame:
    return table(spark, sf, "documents")


def _bench(spark, sf, profile="word") -> TopicBatch:
    return TopicBatch.from_table(table(spark, sf, "benchmark"), "item_id", "text", profile=profile)


def _conv(spark, sf, profile="word") -> TopicBatch:
    return TopicBatch.from_table(table(spark, sf, "conversations"), "conv_id", "text",
                                 field_col="turn", profile=profile)


def _index(spark, sf, profile="word", orders=(1, 2)) -> Index:
    return Index.from_documents(_docs(spark, sf), profile, orders)


def _search(spark, sf, profile="word") -> Search:
    return Search(_docs(spark, sf), _bench(spark, sf, profile), profile)


def _r6(c):
    return F.round(c, 6)


# ---- text --------------------------------------------------------------------

def q_strip_control(spark, sf):
    return _docs(spark, sf).select("doc_id", T.strip_control("text").alias("clean"))


def q_strip_punct(spark, sf):
    # stand-in input: the six marks put after words, which the tables lack
    marked = F.col("text")
    for mark, letter in zip(T.FULLWIDTH_MARKS, "aeinst"):
        marked = F.replace(marked, F.lit(f"{letter} "), F.lit(f"{letter}{mark} "))
    return _docs(spark, sf).select("doc_id", T.strip_punct(marked).alias("clean"))


def q_char_unigrams(spark, sf):
    b = table(spark, sf, "benchmark")
    return (b.select("item_id", F.explode(T.char_unigrams("text")).alias("term"))
             .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("tf")))


def q_char_bigrams(spark, sf):
    b = table(spark, sf, "benchmark")
    return (b.select("item_id", F.explode(T.char_bigrams("text")).alias("p"))
             .groupBy("item_id", F.col("p.t1").alias("t1"), F.col("p.t2").alias("t2"))
             .agg(F.count(F.lit(1)).alias("tf")))


def _vocab(spark, sf) -> DataFrame:
    """Stand-in vocabulary: words found in at least two documents, ids
    1, 2, ... in term order (0 stays 'unknown')."""
    t = _index(spark, sf, orders=(1,)).terms.where((F.col("n") == 1) & (F.col("df") >= 2)).select(F.col("t1").alias("term"))
    return ordered_ids(t, ["term"], "term_id", start=1).select("term", F.col("term_id").cast("int"))


def _vocab_seq(spark, sf) -> DataFrame:
    fields = fields_from_table(table(spark, sf, "benchmark"), "item_id", "text")
    return vocab_sequence(fields, _vocab(spark, sf), T.WORD)


def q_vocab_lookup(spark, sf):
    return _vocab_seq(spark, sf).select(F.col("topic_id").alias("item_id"), "pos", "term_id")


def q_vocab_unigrams(spark, sf):
    g = vocab_grams(_vocab_seq(spark, sf))
    return g.where(F.col("n") == 1).select(F.col("topic_id").alias("item_id"), "pos",
                                           F.col("t1").alias("term_id"))


def q_vocab_bigrams(spark, sf):
    g = vocab_grams(_vocab_seq(spark, sf))
    return g.where(F.col("n") == 2).select(F.col("topic_id").alias("item_id"), "pos", "t1", "t2")


def q_topic_fields(spark, sf):
    return (_conv(spark, sf).grams.groupBy("topic_id", "field", "n", "t1", "t2")
            .agg(F.count(F.lit(1)).alias("tf")))


def q_concept_split(spark, sf):
    fields = split_concepts(fields_from_table(table(spark, sf, "benchmark"), "item_id", "text"),
                            LATIN_CONCEPT_DELIMITER)
    return (field_grams(fields, T.WORD).groupBy("topic_id", "n", "t1", "t2")
            .agg(F.count(F.lit(1)).alias("tf")))


def q_topic_bag(spark, sf):
    return _conv(spark, sf).terms()


def q_topic_number(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.topic_number("url").alias("topic_no"))


def q_doc_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.doc_key("url").alias("doc_key"))


def q_real_doc_len(spark, sf):
    p = table(spark, sf, "pages")
    title = F.coalesce(T.cleaned_length(T.html_title("html")), F.lit(0).cast("long"))
    paras = F.transform(T.html_paragraphs("html"), lambda s: T.cleaned_length(s))
    text = F.aggregate(paras, F.lit(0).cast("long"), lambda a, b: a + b)
    return (p.select("page_id", title.alias("title_len"), text.alias("text_len"))
             .withColumn("doc_len", F.col("title_len") + F.col("text_len")))


# ---- index -------------------------------------------------------------------

def q_postings_unigram(spark, sf):
    return _index(spark, sf, orders=(1,)).postings.select("t1", "doc_id", "tf")


def q_postings_bigram(spark, sf):
    return _index(spark, sf, orders=(2,)).postings.select("t1", "t2", "doc_id", "tf")


def q_doc_freq(spark, sf):
    return _index(spark, sf).terms.select("n", "t1", "t2", "df")


def q_doc_length(spark, sf):
    return _index(spark, sf).doc_lengths


def q_avg_doc_length(spark, sf):
    return _index(spark, sf).corpus().select("avgdl")


def q_doc_count(spark, sf):
    return _index(spark, sf).listed.agg(F.count(F.lit(1)).alias("n_docs"))


def q_bigram_vocab(spark, sf):
    return _index(spark, sf, orders=(2,)).terms.select("t1", "t2")


def q_doc_norm_unigram(spark, sf):
    return (_index(spark, sf, orders=(1,)).doc_norms().where(F.col("n") == 1)
            .select("doc_id", _r6(F.col("l2")).alias("l2")))


def q_doc_norm_bigram(spark, sf):
    return (_index(spark, sf, orders=(2,)).doc_norms().where(F.col("n") == 2)
            .select("doc_id", _r6(F.col("l2")).alias("l2")))


# ---- topics --------------------------------------------------------------------

def q_topic_tf(spark, sf):
    return _bench(spark, sf).terms()


def q_topic_doc_freq(spark, sf):
    return _bench(spark, sf).doc_freq()


def q_topic_count(spark, sf):
    return _bench(spark, sf).ids.agg(F.count(F.lit(1)).alias("n_topics"))


# ---- weights ---------------------------------------------------------------------

def q_idf(spark, sf):
    idx = _index(spark, sf)
    return idx.terms.select("n", "t1", "t2", _r6(W.idf(idx.n_docs(), F.col("df"))).alias("idf"))


def q_idf_truncated(spark, sf):
    idx = _index(spark, sf)
    return idx.terms.select("n", "t1", "t2",
                            _r6(W.idf_truncated(idx.n_docs(), F.col("df"))).alias("idf"))


def q_tfidf(spark, sf):
    idx = _index(spark, sf).materialized()
    idf = W.idf(idx.n_docs(), F.col("df"))
    return (idx.postings_with_df()
            .select("n", "t1", "t2", "doc_id", _r6(W.tfidf(F.col("tf"), idf)).alias("tfidf")))


def q_length_norm(spark, sf):
    idx = _index(spark, sf)
    return idx.doc_lengths.select("doc_id", _r6(W.length_norm(F.col("dl"), idx.avgdl())).alias("norm"))


def q_topic_weight(spark, sf):
    s = _search(spark, sf)
    norm = W.length_norm(F.col("dl"), s.avgdl)
    return s.matches().select("topic_id", "n", "t1", "t2", "doc_id", _r6(
        W.topic_weight(F.col("qtf"), s.n_topics, F.col("qdf"), norm)).alias("weight"))


def q_doc_weight(spark, sf):
    idx = _index(spark, sf).materialized()
    norm = W.length_norm(F.col("dl"), idx.avgdl())
    return (idx.postings_with_df()
            .select("n", "t1", "t2", "doc_id",
                    _r6(W.doc_weight(F.col("tf"), idx.n_docs(), F.col("df"), norm)).alias("weight")))


# ---- matching and scoring ------------------------------------------------------

def q_match_unigram(spark, sf):
    return (_search(spark, sf).matches().where(F.col("n") == 1)
            .select("topic_id", "t1", "doc_id", "qtf", "tf"))


def q_match_bigram(spark, sf):
    return (_search(spark, sf).matches().where(F.col("n") == 2)
            .select("topic_id", "t1", "t2", "doc_id", "qtf", "tf"))


def _order_scores(spark, sf, n):
    s = _search(spark, sf)
    q = s.qstats().where(F.col("n") == n)
    share = 1.0 if n == 1 else 0.0
    return s.ranked(S.vsm_factors(q, s.n_docs, s.n_topics, share), TOPK_K)


def q_score_unigram(spark, sf):
    return _order_scores(spark, sf, 1)


def q_score_bigram(spark, sf):
    return _order_scores(spark, sf, 2)


def q_score_fused(spark, sf):
    s = _search(spark, sf)
    return s.ranked(s.factors(), K)


def q_topk(spark, sf):
    s = _search(spark, sf)
    return s.ranked(s.factors(), TOPK_K)


def q_feedback_docs(spark, sf):
    return _search(spark, sf).feedback_docs()


def q_feedback_terms_unigram(spark, sf):
    return _search(spark, sf).feedback_terms().where(F.col("n") == 1).select("topic_id", "t1")


def q_feedback_terms_bigram(spark, sf):
    return _search(spark, sf).feedback_terms().where(F.col("n") == 2).select("topic_id", "t1", "t2")


def q_score_feedback(spark, sf):
    s = _search(spark, sf)
    return s.ranked(s.boosted_factors(), K)


# ---- whole searches -------------------------------------------------------------

def q_search(spark, sf):
    return search(_docs(spark, sf), _bench(spark, sf), k=K)


def q_search_feedback(spark, sf):
    return search(_docs(spark, sf), _bench(spark, sf), k=K, feedback=True)


def q_search_char(spark, sf):
    return search(_docs(spark, sf), _bench(spark, sf, "char"), k=K, profile="char")


def q_search_conversations(spark, sf):
    return search(_docs(spark, sf), _conv(spark, sf), k=K)


def q_search_vocab_ids(spark, sf):
    """Topics as vocabulary ids against postings of ids (the form of inverted
    files); words outside the vocabulary break bigrams."""
    vocab = written(_vocab(spark, sf), "words")
    postings = written(vocab_postings(_docs(spark, sf), vocab, T.WORD), "ids")
    topics = TopicBatch.from_vocabulary(fields_from_table(table(spark, sf, "benchmark"), "item_id", "text"), vocab, T.WORD)
    return search(Index.from_postings(postings, _docs(spark, sf).select("doc_id")), topics, k=K)


def q_search_legacy(spark, sf):
    return search_legacy(_docs(spark, sf), _bench(spark, sf), k=K)


def q_score_legacy(spark, sf):
    s = _search(spark, sf)
    factors = S.legacy_factors(s.qstats(), s.n_docs)
    return s.ranked(factors, TOPK_K, normed=False)


def q_cosine_unigram(spark, sf):
    """The best documents with a defined cosine. The texts are cut into words
    twice, for the topics' postings and for the norms: no whole index is written."""
    s = Search(_docs(spark, sf), _bench(spark, sf), orders=(1,))
    return s.ranked_cosine(_index(spark, sf, orders=(1,)).doc_norms(), K)


def q_label_run(spark, sf):
    docs = table(spark, sf, "documents", ["doc_id", "source"])
    bench = table(spark, sf, "benchmark", ["item_id"])
    run = q_search(spark, sf)
    # stand-ins in the shapes the reference's files have: a number string
    # per topic and a relative path per listed document
    numbers = bench.select(F.col("item_id").alias("topic_id"),
                           F.lpad(F.col("item_id").cast("string"), 3, "0").alias("number"))
    paths = docs.select("doc_id", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"))
    return label_run(run, numbers, paths).select("topic_no", "rank", "doc_key")


def _judged(spark, sf) -> DataFrame:
    """Derived judgments: a document is relevant to the topics whose text it holds."""
    return containing(_docs(spark, sf), fields_from_table(table(spark, sf, "benchmark"), "item_id", "text").select("topic_id", "text"))


def q_judgments(spark, sf):
    return _judged(spark, sf)


def q_eval_map(spark, sf):
    judged = _judged(spark, sf).checkpoint(eager=True)
    measured = average_precision(q_search(spark, sf), judged, CUTOFF)
    return measured.select("topic_id", "relevant", "found", *[_r6(F.col(c)).alias(c) for c in ("precision", "recall", "average_precision", "mean_average_precision")])


QUERIES: dict[str, Query] = {
    "judgments": q_judgments,
    "eval_map": q_eval_map,
    "strip_control": q_strip_control,
    "strip_punct": q_strip_punct,
    "char_unigrams": q_char_unigrams,
    "char_bigrams": q_char_bigrams,
    "vocab_lookup": q_vocab_lookup,
    "vocab_unigrams": q_vocab_unigrams,
    "vocab_bigrams": q_vocab_bigrams,
    "topic_fields": q_topic_fields,
    "concept_split": q_concept_split,
    "topic_bag": q_topic_bag,
    "topic_number": q_topic_number,
    "doc_key": q_doc_key,
    "real_doc_len": q_real_doc_len,
    "postings_unigram": q_postings_unigram,
    "postings_bigram": q_postings_bigram,
    "doc_freq": q_doc_freq,
    "doc_length": q_doc_length,
    "avg_doc_length": q_avg_doc_length,
    "doc_count": q_doc_count,
    "bigram_vocab": q_bigram_vocab,
    "doc_norm_unigram": q_doc_norm_unigram,
    "doc_norm_bigram": q_doc_norm_bigram,
    "topic_tf": q_topic_tf,
    "topic_doc_freq": q_topic_doc_freq,
    "topic_count": q_topic_count,
    "idf": q_idf,
    "idf_truncated": q_idf_truncated,
    "tfidf": q_tfidf,
    "length_norm": q_length_norm,
    "topic_weight": q_topic_weight,
    "doc_weight": q_doc_weight,
    "match_unigram": q_match_unigram,
    "match_bigram": q_match_bigram,
    "score_unigram": q_score_unigram,
    "score_bigram": q_score_bigram,
    "score_fused": q_score_fused,
    "topk": q_topk,
    "feedback_docs": q_feedback_docs,
    "feedback_terms_unigram": q_feedback_terms_unigram,
    "feedback_terms_bigram": q_feedback_terms_bigram,
    "score_feedback": q_score_feedback,
    "search": q_search,
    "search_feedback": q_search_feedback,
    "search_char": q_search_char,
    "search_conversations": q_search_conversations,
    "search_vocab_ids": q_search_vocab_ids,
    "search_legacy": q_search_legacy,
    "score_legacy": q_score_legacy,
    "cosine_unigram": q_cosine_unigram,
    "label_run": q_label_run,
}
