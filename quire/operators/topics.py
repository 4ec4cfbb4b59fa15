"""Topics as weighted term bags.

A topic has several text fields; each field (and each entry of a concepts
field) is tokenized on its own, so no bigram spans two fields, and the
grams of all fields are added up with repeats kept (a bag, not a set).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions.text import CONCEPT_DELIMITER, Profile, profile_named, strip_control
from quire.operators.bounded import n_slices, sliced_join
from quire.operators.index import TERM_KEYS, explode_grams


def fields_from_table(df: DataFrame, id_col: str, text_col: str,
                      field_col: str | None = None) -> DataFrame:
    """``(topic_id, field, text)`` from a table of topics or topic fields."""
    fld = F.col(field_col).cast("string") if field_col else F.lit("0")
    return df.select(F.col(id_col).cast("long").alias("topic_id"), fld.alias("field"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def split_concepts(fields: DataFrame, delimiter: str = CONCEPT_DELIMITER) -> DataFrame:
    """Each entry of a delimited field becomes a field of its own.

    Control characters are deleted before splitting; the entries are
    cleaned again by the profile when tokenized.
    """
    parts = F.posexplode(F.split(strip_control(F.col("text")), _literal_regex(delimiter)))
    return (fields.select("topic_id", "field", parts.alias("part", "entry"))
                  .select("topic_id", F.concat_ws("#", "field", F.col("part").cast("string")).alias("field"),
                          F.col("entry").alias("text")))


def _literal_regex(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in s)


def field_grams(fields: DataFrame, profile: Profile, orders=(1, 2)) -> DataFrame:
    """One row per gram occurrence: ``topic_id, field, n, t1, t2``."""
    seqs = fields.select("topic_id", "field", profile.sequence(F.col("text")).alias("seq"))
    return explode_grams(seqs, profile, ["topic_id", "field"], orders)


def vocab_sequence(fields: DataFrame, vocab: DataFrame, profile: Profile) -> DataFrame:
    """Items of each field mapped to vocabulary ids, unknown -> 0.

    ``vocab(term STRING, term_id INT)``. Only the vocabulary entries that
    occur in the topics are pulled out of the (possibly large) vocabulary:
    the topic side is the small one, so it is the one broadcast.
    """
    items = fields.select("topic_id", "field",
                          F.posexplode(profile.sequence(F.col("text"))).alias("pos", "term"))
    wanted = items.select("term").distinct()
    hits = sliced_join(vocab.select("term", F.col("term_id").cast("int")), wanted, ["term"], n_slices(wanted, ["term"]), "left_semi")
    return (items.join(hits, "term", "left")
                 .select("topic_id", "field", "pos", "term",
                         F.coalesce("term_id", F.lit(0)).alias("term_id")))


def vocab_grams(seq_ids: DataFrame) -> DataFrame:
    """Unigrams with known ids (T7) and bigrams of two known neighbours
    (T8): ``topic_id, field, pos, n, t1, t2`` with integer ids, t2 = -1 for
    unigrams. An unknown item breaks the chain; it is never bridged."""
    w = Window.partitionBy("topic_id", "field").orderBy("pos")
    nxt = seq_ids.withColumn("next_id", F.lead("term_id").over(w))
    uni = (nxt.where(F.col("term_id") > 0)
              .select("topic_id", "field", "pos", F.lit(1).alias("n"),
                      F.col("term_id").alias("t1"), F.lit(-1).alias("t2")))
    bi = (nxt.where((F.col("term_id") > 0) & (F.col("next_id") > 0))
             .select("topic_id", "field", "pos", F.lit(2).alias("n"),
                     F.col("term_id").alias("t1"), F.col("next_id").alias("t2")))
    return uni.unionByName(bi)


def topic_terms(grams: DataFrame) -> DataFrame:
    """qtf per (topic, term), repeats counted."""
    return grams.groupBy("topic_id", *TERM_KEYS).agg(F.count(F.lit(1)).alias("qtf"))


def topic_doc_freq(terms: DataFrame) -> DataFrame:
    """Topics of the batch containing each term."""
    return terms.groupBy(*TERM_KEYS).agg(F.count(F.lit(1)).alias("qdf"))


@dataclass
class TopicBatch:
    """A batch of topics scored together.

    ``ids`` lists every topic of the batch (also those without a single
    known term: they count in Q, A9); ``grams`` holds the term occurrences.
    Query weights depend on the whole batch (Q and qdf), so the batch is
    the unit of a search.
    """

    ids: DataFrame
    grams: DataFrame
    profile: str | None = None  # how the topics were tokenized, if by a profile

    @classmethod
    def from_fields(cls, fields: DataFrame, profile: Profile | str = "word",
                    orders=(1, 2), ids: DataFrame | None = None) -> "TopicBatch":
        profile = profile_named(profile)
        ids = ids if ids is not None else fields.select("topic_id").distinct()
        return cls(ids.select(F.col("topic_id").cast("long")), field_grams(fields, profile, orders), profile.name)

    @classmethod
    def from_vocabulary(cls, fields: DataFrame, vocab: DataFrame, profile: Profile | str = "char",
                        ids: DataFrame | None = None) -> "TopicBatch":
        """Topics as vocabulary ids (T6-T8), for an index of integer terms."""
        profile = profile_named(profile)
        ids = ids if ids is not None else fields.select("topic_id").distinct()
        grams = vocab_grams(vocab_sequence(fields, vocab, profile)).select("topic_id", "field", *TERM_KEYS)
        return cls(ids.select(F.col("topic_id").cast("long")), grams)

    @classmethod
    def from_table(cls, df: DataFrame, id_col: str, text_col: str, field_col: str | None = None,
                   profile: Profile | str = "word", orders=(1, 2)) -> "TopicBatch":
        ids = df.select(F.col(id_col).cast("long").alias("topic_id")).distinct()
        return cls.from_fields(fields_from_table(df, id_col, text_col, field_col), profile,
                               orders, ids)

    def terms(self) -> DataFrame:
        return topic_terms(self.grams)

    def doc_freq(self) -> DataFrame:
        return topic_doc_freq(self.terms())

    def count(self):
        """Q, topics in the batch, as a scalar subquery."""
        return self.ids.select(F.count(F.lit(1))).scalar()

    def weighted_terms(self) -> DataFrame:
        """``topic_id, n, t1, t2, qtf, qdf``: Q and qdf cover the whole batch."""
        tt = self.terms()
        return tt.join(topic_doc_freq(tt), TERM_KEYS)
