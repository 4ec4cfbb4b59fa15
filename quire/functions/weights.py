"""Term-weighting expressions of the vector space model.

All are plain ``Column`` arithmetic; ANSI mode is on in Spark 4, so every
division that can meet a zero goes through ``try_divide`` (NULL, not an
error) and callers decide what NULL means.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the retrieval model.
# Pivoted length normalisation slope: norm = (1 - b) + b * dl / avgdl.
LENGTH_NORM_B = 0.7
# Weight of the unigram score in the fused score; bigrams get the rest.
UNIGRAM_MIX = 0.2
# Weight of the unigram score in the legacy (un-normalised) score.
LEGACY_UNIGRAM_MIX = 0.8
# Factor applied to query terms found in the feedback documents.
FEEDBACK_BOOST = 2.0
# Number of first-pass documents used for feedback.
FEEDBACK_DOCS = 5
# Number of documents ranked per topic.
DEFAULT_TOP_K = 100
# ---------------------------------------------------------------------------


def _d(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("double")


def integer_div(a: Column, b: Column) -> Column:
    """Integer division of non-negative whole numbers; NULL by 0."""
    return F.try_divide(a - F.try_mod(a, b), b).cast("long")


def idf(n_docs, df) -> Column:
    """log2(N / df) in doubles (W1); NULL when df is 0."""
    return F.log2(F.try_divide(_d(n_docs), _d(df)))


def idf_truncated(n_docs, df) -> Column:
    """log2 of the integer quotient N div df (W2): 0 once df > N / 2."""
    return F.log2(integer_div(_c(n_docs).cast("long"), _c(df).cast("long")).cast("double"))


def tfidf(tf, idf_col) -> Column:
    """tf * idf (W3)."""
    return _d(tf) * idf_col


def length_norm(dl, avgdl) -> Column:
    """(1 - b) + b * dl / avgdl (W4); NULL when avgdl is 0."""
    return F.lit(1.0 - LENGTH_NORM_B) + F.lit(LENGTH_NORM_B) * F.try_divide(_d(dl), _d(avgdl))


def query_idf(n_topics, qdf) -> Column:
    """log2(Q / qdf): 0 for a term found in every topic of the batch."""
    return F.log2(F.try_divide(_d(n_topics), _d(qdf)))


def topic_weight(qtf, n_topics, qdf, norm) -> Column:
    """qtf * log2(Q / qdf) / norm (W5); the norm is the document's."""
    return F.try_divide(_d(qtf), norm) * query_idf(n_topics, qdf)


def doc_weight(tf, n_docs, df, norm) -> Column:
    """tf * log2(N / df) / norm."""
    return F.try_divide(_d(tf), norm) * idf(n_docs, df)


def gram_mix(n: Column, unigram_share: float = UNIGRAM_MIX) -> Column:
    """Per-row factor that turns one sum over both orders into the mix."""
    return F.when(n == 1, F.lit(unigram_share)).otherwise(F.lit(1.0 - unigram_share))


def rank_score(score: Column) -> Column:
    """Scores are ranked (and reported) at 6 decimals so that the order of
    floating-point summation can never reorder documents."""
    return F.round(score, 6)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)
