"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.conversations import damaged, reports
from quire.llm.embedding_dedup import embedding_links
from quire.llm.fim import fill_in_middle, restored
from quire.llm.langid import identify
from quire.llm.line_dedup import removed_lines
from quire.llm.lm_score import score_texts
from quire.llm.mixing import taken_words
from quire.llm.ngram_join import ngram_components
from quire.llm.oracles import ORACLES
from quire.llm.packing import packed_pieces
from quire.llm.passage_dedup import repeats
from quire.llm.pii import replaced
from quire.llm.quality import quality
from quire.llm.scratch import Scratch
from quire.llm.shipping import ship
from quire.llm.token_files import read_digests, write_tokens
from quire.sources.tables import table

PII_KEY = "not-a-secret"      # a deployment passes a key of its own


def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have Jaccard >= 0.85."""
    return ngram_components(table(spark, sf, "documents"), Scratch(spark, "op1")).drop("row")


def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Passages of 50 words or more that repeat across documents or inside one."""
    return repeats(table(spark, sf, "documents"), Scratch(spark, "op2"))


def op3_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every token piece of every document with its sequence and offset."""
    import public_tokenizers

    return packed_pieces(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), Scratch(spark, "op3"))


def op4_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Backoff-automaton scores of every document; rows with remainder 1 are
    held out from learning."""
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("long"), F.coalesce(rest == 1, F.lit(False)).alias("held_out"),
                                                F.coalesce(rest != 1, F.lit(False)).alias("learn"), "text")
    return score_texts(docs, Scratch(spark, "op4"))


def op5_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """How much of every document the mix of all sources takes."""
    return taken_words(table(spark, sf, "documents", ["doc_id", "text", "source"]), Scratch(spark, "op5")).drop("row")


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted language of every document; rows with remainder 2 are held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = table(spark, sf, "documents", ["doc_id", "text", "lang"])
    return identify(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    return quality(table(spark, sf, "documents", ["doc_id", "text", "source"]), Scratch(spark, "op6"))


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of every document that an earlier near or equal line makes redundant."""
    docs = table(spark, sf, "documents").select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return removed_lines(docs, Scratch(spark, "op8")).select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")


def op9_pii_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its personal data replaced by keyed surrogates."""
    return replaced(table(spark, sf, "documents"), PII_KEY, Scratch(spark, "op9"))


def op10_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Links, components and kept vectors of all embeddings, within labels."""
    return embedding_links(table(spark, sf, "embeddings", ["vec_id", "embedding", "label"]), Scratch(spark, "op10"))


def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in its fill-in-the-middle form, with digests of the output
    and of the text rebuilt from it."""
    made = fill_in_middle(table(spark, sf, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults, cheapest audit and digest of the repair of every conversation,
    after planted damage; conversations that lose all rows have zeros."""
    rows = table(spark, sf, "conversations")
    found = reports(damaged(rows), Scratch(spark, "op12"))
    ids = rows.select(F.col("conv_id").cast("long").alias("_conv")).distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (ids.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
               .select(F.col("_conv").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def op13_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's place, length and checksum as read back from the token
    files written of all documents."""
    import public_tokenizers

    scratch = Scratch(spark, "op13")
    write_tokens(table(spark, sf, "documents"), f"{scratch.root}/files", public_tokenizers.path("word_bpe_49k.json"), scratch)
    return read_digests(spark, f"{scratch.root}/files")


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return query(spark, sf)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: _shipped(q) for q in (
    op1_ngram_join,
    op2_substring_dedup,
    op3_best_fit_packing,
    op4_lm_scoring,
    op5_source_mixing,
    op6_quality_rules,
    op7_language_id,
    op8_line_dedup,
    op9_pii_surrogates,
    op10_embedding_dedup,
    op11_fill_in_middle,
    op12_conversation_repair,
    op13_token_files,
)}
