"""Whole-batch search plans (J9 ``search`` / ``search_feedback``, J11
``search_legacy``).

One call answers every topic of a batch with one Spark plan:

    topics -> weighted terms (small, counted, broadcast)
    documents -> token sequences -> grams of the query terms only (in the
    scan) -> dealt by document -> postings, written once
    postings x topic terms, block by block -> /norm^2 -> the best k per topic
    and task (``operators.products``) -> top k -> zero fill
    [-> feedback terms -> boosted re-score]

Texts are never shuffled, and (topic, document) rows only after the partial
top k: what moves is the query terms' postings and topics x k rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import weights as W
from quire.functions.text import Profile, profile_named
from quire.operators import index as index_module
from quire.operators import scoring as S
from quire.operators.bounded import n_slices, sliced_join
from quire.operators.index import TERM_KEYS, Index
from quire.operators.products import best_scores
from quire.operators.ranking import ranked_with_zeros, top_k
from quire.operators.topics import TopicBatch
from quire.operators.written import written


class Search:
    """The pieces of one batch search, exposed for inspection and tests.

    Building one starts no job; the topic terms are weighed and the postings
    written when a piece is first asked for.
    """

    def __init__(self, source: Index | DataFrame, topics: TopicBatch,
                 profile: Profile | str = "word", orders=(1, 2)):
        self.profile = profile_named(profile)
        self.topics = topics
        self.source = source
        self.orders = orders
        indexed = source.profile if isinstance(source, Index) else self.profile
        if topics.profile and indexed and topics.profile != indexed.name:
            raise ValueError(f"topics are tokenized by profile {topics.profile!r}, documents by {indexed.name!r}")
        self.qterms = topics.weighted_terms()
        self.n_topics = topics.count()

    @cached_property
    def n_slices(self) -> int:
        """Broadcast slices that hold the weighted topic terms."""
        return n_slices(self.qterms, ["t1", "t2"])

    @cached_property
    def index(self) -> Index:
        terms = self.topics.terms()
        if isinstance(self.source, Index):
            return self.source.restricted(terms)
        return Index.from_documents(self.source, self.profile, self.orders, restrict_to=terms).materialized()

    @property
    def n_docs(self):
        return self.index.n_docs()

    @property
    def avgdl(self):
        return self.index.avgdl()

    def qstats(self) -> DataFrame:
        return S.query_stats(self.index, self.qterms)

    def matches(self, qstats: DataFrame | None = None) -> DataFrame:
        return S.match(self.index, qstats if qstats is not None else self.qstats(), self.n_slices)

    def factors(self, nonzero: bool = False) -> DataFrame:
        """Topic terms with their document-independent factor ``f``. With
        ``nonzero`` the pairs whose factor is exactly 0 - a term in every topic
        of the batch, or in every document - are dropped before the fan-out:
        they add nothing to any score."""
        out = S.vsm_factors(self.qstats(), self.n_docs, self.n_topics)
        return out.where(F.col("f") != 0) if nonzero else out

    def contributions(self, nonzero: bool = False, factors: DataFrame | None = None) -> DataFrame:
        """Per matched (topic, term, document) weight ``w``."""
        return S.contributions(self.matches(factors if factors is not None else self.factors(nonzero)))

    def scores(self, contrib: DataFrame | None = None) -> DataFrame:
        """Sparse scores of matched pairs."""
        return S.vsm_scores(contrib if contrib is not None else self.contributions(), self.avgdl)

    def rank(self, scores: DataFrame, k: int) -> DataFrame:
        """Top ``k`` of all listed documents per topic (J4 + J5)."""
        return ranked_with_zeros(scores, self.topics.ids, self.index.listed, k, self.index.listed_only)

    def ranked(self, factors: DataFrame, k: int, normed: bool = True) -> DataFrame:
        """Top ``k`` per topic by the sums of ``factors`` times tf, divided by the
        squared length norm if ``normed``. They are summed block by block; with
        postings of unlisted documents, whose scores may be negative and are all
        needed for the zero fill, as rows."""
        if not self.index.listed_only:
            contrib = self.contributions(factors=factors)
            return self.rank(self.scores(contrib) if normed else S.sum_scores(contrib), k)
        norm = W.length_norm(F.col("dl"), self.avgdl)
        # an average length of 0 makes the norm infinite
        by = F.coalesce(norm * norm, F.lit(float("inf"))) if normed else F.lit(1.0)
        found = best_scores(self.index.postings_all, factors, by, k)
        return self.rank(found.withColumn("score", W.rank_score(F.col("score"))), k)

    def ranked_cosine(self, norms: DataFrame, k: int) -> DataFrame:
        """Top ``k`` of the matched documents with a defined cosine (J12): ``norms``
        holds their unigram norm, once for every time a document is listed.

        Positive scores come from block products. A topic with fewer than ``k``
        of them is filled with matched documents that score 0, by id."""
        rows = norms.where("n = 1 AND l2 > 0").groupBy("doc_id").agg(F.max("l2").alias("l2"), F.count(F.lit(1)).cast("int").alias("times"))
        defined = written(rows, "norms")
        factors = S.cosine_factors(self.qstats(), self.n_docs).select("topic_id", *TERM_KEYS, "f").checkpoint(eager=True)
        found = best_scores(self.index.postings_all.join(defined.select("doc_id", "l2"), "doc_id"), factors.where("f <> 0"), F.col("l2"), k)
        scored = found.withColumn("score", W.rank_score(F.col("score"))).where("score > 0")
        top = top_k(scored, k).drop("rank").checkpoint(eager=True)
        filled = top.groupBy("topic_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        lacking = factors.join(filled, "topic_id", "left_anti").select("topic_id", *TERM_KEYS).checkpoint(eager=True)
        if not lacking.isEmpty():
            held = sliced_join(self.index.postings_all, lacking, TERM_KEYS, n_slices(lacking, ["t1", "t2"])).select("topic_id", "doc_id").distinct()
            zeros = held.join(defined, "doc_id", "left_semi").join(top, ["topic_id", "doc_id"], "left_anti").withColumn("score", F.lit(0.0))
            top = top.unionByName(top_k(zeros.select("topic_id", "doc_id", "score"), k).drop("rank")).checkpoint(eager=True)
        listed = sliced_join(defined.select("doc_id", "times"), top, ["doc_id"], n_slices(top, []))
        return top_k(listed.select("topic_id", "doc_id", "score", F.explode(F.sequence(F.lit(1), "times"))).drop("col"), k)

    def feedback_docs(self, k: int = W.FEEDBACK_DOCS) -> DataFrame:
        """First-pass top ``k`` of each topic."""
        return self.ranked(self.factors(nonzero=True), k)

    def feedback_terms(self, nonzero: bool = False) -> DataFrame:
        """Looked up in the postings of the feedback documents alone, a few per
        topic, so the collection is not matched again for them."""
        docs = self.feedback_docs().select("topic_id", "doc_id").checkpoint(eager=True)
        found = S.match(self.index, self.factors(nonzero), self.n_slices, docs.select("doc_id").distinct())
        return S.feedback_terms(found, docs)

    def boosted_factors(self, nonzero: bool = False) -> DataFrame:
        """Factors, those of the feedback terms doubled."""
        return S.boost_feedback(self.factors(nonzero), self.feedback_terms(nonzero))

    def boosted(self, nonzero: bool = False) -> DataFrame:
        """Contributions with the feedback terms' factors doubled."""
        return self.contributions(factors=self.boosted_factors(nonzero))

    # ---- top k of a saved index by block bounds -------------------------------

    @cached_property
    def saved_factors(self) -> DataFrame:
        """Non-zero factors of the topic terms, from the saved df."""
        source, keep = self.source, self.topics.terms().select(*TERM_KEYS).distinct()
        df = sliced_join(source.terms_all.select(*TERM_KEYS, "df"), keep, TERM_KEYS, n_slices(keep, ["t1", "t2"]), "left_semi")
        factors = S.vsm_factors(self.qterms.join(df, TERM_KEYS), source.n_docs(), self.n_topics)
        return factors.where(F.col("f") != 0).select("topic_id", *TERM_KEYS, "f").checkpoint(eager=True)

    def bounds(self) -> DataFrame:
        """``topic_id, block, bound``: what no document of the block can exceed."""
        return (sliced_join(self.source.blocks, self.saved_factors, TERM_KEYS, self.n_slices)
                .groupBy("topic_id", "block").agg(F.sum(F.col("f") * F.col("top")).alias("bound")))

    def postings_of(self, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Saved postings of the topics' terms in the ``wanted`` (``topic_id,
        block``), and the terms asked for in each block."""
        asks = self.saved_factors.join(wanted.select("topic_id", "block"), "topic_id")
        pairs = asks.select(*TERM_KEYS, "block").distinct()
        return sliced_join(self.source.postings_all, pairs, [*TERM_KEYS, "block"], n_slices(pairs, ["t1", "t2"]), "left_semi"), asks

    def block_scores(self, wanted: DataFrame) -> DataFrame:
        """Sparse scores of the wanted topics and blocks."""
        postings, asks = self.postings_of(wanted)
        matched = sliced_join(postings.repartition("doc_id"), asks, [*TERM_KEYS, "block"], n_slices(asks, ["t1", "t2"]))
        return S.vsm_scores(S.contributions(matched), self.source.avgdl())

    def block_plan(self, k: int) -> tuple[DataFrame, DataFrame]:
        """The top ``k`` of each topic's most promising blocks (as many as hold
        ``k`` documents), and the other blocks that can still reach it: those
        whose bound is not below the k-th score found."""
        bounds = self.bounds().checkpoint(eager=True)
        best = Window.partitionBy("topic_id").orderBy(F.col("bound").desc(), "block")
        numbered = bounds.withColumn("at", F.row_number().over(best)).checkpoint(eager=True)
        seeds = F.col("at") <= k // index_module.BLOCK_DOCS + 1
        first = top_k(self.block_scores(numbered.where(seeds)).where("score <> 0"), k).drop("rank").checkpoint(eager=True)
        reached = first.groupBy("topic_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("topic_id", "least")
        # scores are ranked at six decimals: a bound short of that by rounding counts as reaching it
        open_blocks = (numbered.where(~seeds).join(reached, "topic_id", "left")
                       .where(F.col("bound") * (1 + 1e-9) + 1e-6 >= F.coalesce("least", F.lit(0.0))).select("topic_id", "block"))
        return first, open_blocks.checkpoint(eager=True)

    def run_blocks(self, k: int) -> DataFrame:
        """Top ``k`` from a saved index, reading the blocks that can matter. The
        rows are those of :meth:`run` over all postings: a topic whose first
        blocks do not fill its top ``k`` gets all its blocks."""
        first, open_blocks = self.block_plan(k)
        scores = first.unionByName(self.block_scores(open_blocks))
        return ranked_with_zeros(scores, self.topics.ids, self.source.listed, k, True)

    def run(self, k: int = W.DEFAULT_TOP_K, feedback: bool = False) -> DataFrame:
        if not feedback and isinstance(self.source, Index) and self.source.blocks is not None and self.source.listed_only:
            return self.run_blocks(k)
        return self.ranked(self.boosted_factors(nonzero=True) if feedback else self.factors(nonzero=True), k)

    def legacy_factors(self) -> DataFrame:
        # terms with df > N/2 have a truncated unigram idf of 0 and add nothing
        return S.legacy_factors(self.qstats(), self.n_docs).where(F.col("f") != 0)


def search(source: Index | DataFrame, topics: TopicBatch, k: int = W.DEFAULT_TOP_K,
           feedback: bool = False, profile: Profile | str = "word") -> DataFrame:
    """Top ``k`` documents per topic: ``topic_id, doc_id, score, rank``.

    ``source`` is a saved/derived :class:`Index` or a documents table
    (``doc_id, text``) tokenized on the fly with ``profile``. With
    ``feedback`` the first-pass top 5 documents of each topic double the
    weight of the query terms they contain, and all documents are scored
    again.
    """
    return Search(source, topics, profile).run(k, feedback)


def search_legacy(source: Index | DataFrame, topics: TopicBatch, k: int = W.DEFAULT_TOP_K,
                  profile: Profile | str = "word") -> DataFrame:
    """Legacy ranking (J11): un-normalised sum of qtf * tf * idf^2, unigram
    idf truncated, 0.8 / 0.2 mix, zero fill, top ``k``."""
    s = Search(source, topics, profile)
    return s.ranked(s.legacy_factors(), k, normed=False)
