"""Matching and scoring.

Scoring is sparse: the (small) weighted topic terms are broadcast into the
postings scan, each posting of a query term yields one contribution row per
topic holding it, and a hash aggregate sums contributions per (topic,
document). Documents that match nothing score 0; ranking fills those in
(see ``ranking``) instead of building topics x documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import weights as W
from quire.operators.bounded import n_slices, sliced_join
from quire.operators.index import TERM_KEYS, Index


def query_stats(index: Index, qterms: DataFrame) -> DataFrame:
    """``topic_id, n, t1, t2, qtf, qdf, df`` for query terms the collection
    has (the inner join drops unseen terms, which score nothing).

    ``index`` must already be restricted to the batch's terms, so this join
    is between two tables no larger than the topic terms."""
    return qterms.join(index.terms_all.select(*TERM_KEYS, "df"), TERM_KEYS)


def match(index: Index, qstats: DataFrame, n: int, docs: DataFrame | None = None) -> DataFrame:
    """Topic terms meet postings on the term (J1): every column of
    ``qstats`` plus ``doc_id, tf, dl``.

    ``qstats`` cannot outgrow the weighed topic terms and is broadcast in
    ``n`` slices: the postings are never shuffled by term, so a hot term
    never piles up in one partition. They are dealt out by document, so
    every later sum per (topic, document) is local. With ``docs`` (``doc_id``,
    each once) only the postings of those documents are matched.
    """
    if docs is None:
        return sliced_join(index.postings_all.repartition("doc_id"), qstats, TERM_KEYS, n)
    return sliced_join(sliced_join(index.postings_all, docs, ["doc_id"], n_slices(docs, []), "left_semi"), qstats, TERM_KEYS, n)


def vsm_factors(qstats: DataFrame, n_docs: Column, n_topics: Column,
                unigram_share: float = W.UNIGRAM_MIX) -> DataFrame:
    """Adds ``f``: everything of W5 * W6 that does not depend on the
    document - mix * qtf * log2(Q/qdf) * log2(N/df) - once per (topic,
    term) on the small side."""
    f = (W.gram_mix(F.col("n"), unigram_share) * F.col("qtf").cast("double")
         * W.query_idf(n_topics, F.col("qdf")) * W.idf(n_docs, F.col("df")))
    return qstats.withColumn("f", f)


def contributions(matches: DataFrame) -> DataFrame:
    """``w = f * tf`` per matched (topic, term, document)."""
    return matches.withColumn("w", F.col("f") * F.col("tf").cast("double"))


def vsm_scores(contrib: DataFrame, avgdl: Column) -> DataFrame:
    """Sum per (topic, document), then divide by the squared length norm
    (J2/J3): both weights carry the document's norm, so it factors out of
    the sum. With an average length of 0 the norm is infinite and the
    score 0, as in the model."""
    raw = (contrib.groupBy("topic_id", "doc_id")
           .agg(F.sum("w").alias("raw"), F.max("dl").alias("dl")))
    norm = W.length_norm(F.col("dl"), avgdl)
    score = F.coalesce(F.try_divide(F.col("raw"), norm * norm), F.lit(0.0))
    return raw.select("topic_id", "doc_id", W.rank_score(score).alias("score"))


def feedback_terms(contrib: DataFrame, fb_docs: DataFrame) -> DataFrame:
    """Query terms with tf > 0 in any feedback document of their topic (J7):
    an existential test, so a left-semi join and a distinct."""
    docs = fb_docs.select("topic_id", "doc_id")
    return (sliced_join(contrib, docs, ["topic_id", "doc_id"], n_slices(docs, []), "left_semi")
                   .select("topic_id", *TERM_KEYS).distinct())


def boost_feedback(qstats: DataFrame, fb_terms: DataFrame, factor: float = W.FEEDBACK_BOOST) -> DataFrame:
    """Factors of feedback terms count ``factor`` times (J8), on the small
    side, before the match; Q and qdf are unchanged and no term is added."""
    marks = fb_terms.select("topic_id", *TERM_KEYS, F.lit(factor).alias("boost"))
    return (qstats.join(marks, ["topic_id", *TERM_KEYS], "left")
                  .withColumn("f", F.col("f") * F.coalesce(F.col("boost"), F.lit(1.0)))
                  .drop("boost"))


def legacy_factors(qstats: DataFrame, n_docs: Column,
                   unigram_share: float = W.LEGACY_UNIGRAM_MIX) -> DataFrame:
    """Legacy score factor (J10): mix * qtf * idf^2, no length norm and no
    query idf; unigrams use the truncated idf, bigrams the exact one; the
    mix is 0.8 / 0.2; qtf counts the repeats of a query term."""
    idf = F.when(F.col("n") == 1, W.idf_truncated(n_docs, F.col("df"))) \
           .otherwise(W.idf(n_docs, F.col("df")))
    f = W.gram_mix(F.col("n"), unigram_share) * F.col("qtf").cast("double") * idf * idf
    return qstats.withColumn("f", f)


def sum_scores(contrib: DataFrame) -> DataFrame:
    """Plain sum per (topic, document), no normalisation."""
    return (contrib.groupBy("topic_id", "doc_id")
                   .agg(W.rank_score(F.sum("w")).alias("score")))


def cosine_factors(qstats: DataFrame, n_docs: Column) -> DataFrame:
    """Cosine numerator factor (J12), unigrams only: qtf * idf * idf with
    the truncated idf (sum over query terms with repeats of idf * tf*idf)."""
    idf = W.idf_truncated(n_docs, F.col("df"))
    return (qstats.where(F.col("n") == 1)
                  .withColumn("f", F.col("qtf").cast("double") * idf * idf))


def cosine_scores(contrib: DataFrame, norms: DataFrame) -> DataFrame:
    """Numerator per (topic, document) over the document's unigram L2 norm;
    documents whose norm is 0 have no defined cosine and are left out."""
    sums = contrib.groupBy("topic_id", "doc_id").agg(F.sum("w").alias("num"))
    uni = norms.where(F.col("n") == 1).select("doc_id", "l2")
    return (sums.join(uni, "doc_id")
                .select("topic_id", "doc_id",
                        W.rank_score(F.try_divide(F.col("num"), F.col("l2"))).alias("score"))
                .where(F.col("score").isNotNull()))
