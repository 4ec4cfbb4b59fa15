"""Quality rules: word and symbol counts, repeats, and cross-document line
frequency per host. Built-in functions only.

Per text: counts of words, symbols, repeated lines and words in repeated
five-word windows. Across texts: lines are normalised (lower case, single
blanks) and hashed, and the distinct documents of each (host, line) are
counted. A line above either limit is boilerplate of its host; a document that
keeps too little after boilerplate is removed is depleted and rejected.

Defined results: a null text has all counts 0 and fails the base rules; a
null host is a host of its own; repeated rows of a ``doc_id`` count as one
document in line frequencies and keep a row each; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
LINE_DOCS = 50          # a host's line in more documents than this is boilerplate ...
LINE_SHARE = 0.01       # ... and so is one in more than this share of the host's documents,
SHARE_DOCS = 5          # if these are more than this
LEAST_LEFT = 0.3        # share of its words a document must keep


def _without(column, chars: str):
    return F.translate(column, chars, "")


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (``text`` and others) with the counts of the base rules and
    ``lines``: hash and words of every line that has a word."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = docs.withColumn("text", text)
    out = (out.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
              .withColumn("split", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))))
    out = (out.withColumn("n_words", F.size("words").cast("long"))
              .withColumn("word_chars", F.length(_without("text", SPACES)).cast("long"))
              .withColumn("n_symbols", (F.length("text") - F.length(_without("text", SYMBOLS))).cast("long"))
              .withColumn("n_dup_lines", (F.size("split") - F.size(F.array_distinct("split"))).cast("long"))
              .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
              .withColumn("lines", F.transform(
                  F.transform("split", lambda x: F.trim(F.regexp_replace(F.lower(x), r"[\x09-\x0D]|[\x20\x09-\x0D]{2,}", " "))),
                  lambda x: F.struct(F.xxhash64(x).alias("line"), (F.length(x) - F.length(_without(x, " ")) + 1).alias("words")))))
    out = out.drop("text", "words", "split")
    at = [F.col("hashes")] * WINDOW
    out = out.withColumn("windows", F.when(F.size("hashes") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("hashes") - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k, h in enumerate(at)])))
        .otherwise(F.array().cast("array<long>")))
    # most texts repeat no window: only the others are sorted
    out = out.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:long,i:int>>"))).drop("windows", "hashes")
    same = lambda x, k: F.coalesce(F.get(F.col("sorted"), k - 1)["h"] == x["h"], F.lit(False)) \
        | F.coalesce(F.get(F.col("sorted"), k + 1)["h"] == x["h"], F.lit(False))
    out = out.withColumn("twice", F.array_sort(F.transform(F.filter("sorted", same), lambda x: x["i"]))).drop("sorted")
    # a window covers its words up to the next repeated window
    covers = F.transform("twice", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("twice"), k + 1) - s, F.lit(WINDOW))))
    return out.withColumn("n_repeat_words", F.aggregate(covers, F.lit(0).cast("long"), lambda a, x: a + x)).drop("twice")


def boilerplate(lines: DataFrame, hosts: DataFrame) -> DataFrame:
    """``host, line`` of the lines (``host, doc, line``) above either limit;
    ``hosts`` has ``host, docs``."""
    seen = lines.select("host", "line", "doc").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    return (seen.where(F.col("n") > SHARE_DOCS).join(hosts, "host")
                .where((F.col("n") > LINE_DOCS) | (F.col("n") > F.col("docs") * LINE_SHARE)).select("host", "line"))


def quality(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id`` and the counts, ``n_boilerplate_words``, ``base_failed`` and
    ``kept`` for every row of ``docs`` (``doc_id, text, source``)."""
    host = F.concat(F.when(F.col("source").isNull(), "-").otherwise("+"), F.coalesce("source", F.lit("")))
    rows = base_counts(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text",
                                   host.alias("host")))
    rows = scratch.keep(rows, "counts")
    hosts = scratch.keep(rows.select("host", "doc_id").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("docs")), "hosts")
    lines = rows.select("row", "host", F.col("doc_id").alias("doc"), F.explode("lines").alias("x")) \
                .select("row", "host", "doc", "x.line", "x.words")
    common = scratch.keep(boilerplate(lines, hosts), "boilerplate")
    lost = lines.join(common, ["host", "line"]).groupBy("row").agg(F.sum("words").cast("long").alias("lost"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("n_boilerplate_words")
    depleted = (F.col("n_boilerplate_words") > 0) & ((left < LEAST_WORDS) | (left < F.col("n_words") * LEAST_LEFT))
    return (rows.drop("lines").join(lost, "row", "left").withColumn("n_boilerplate_words", F.coalesce("lost", F.lit(0).cast("long")))
                .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_boilerplate_words",
                        failed.alias("base_failed"), (~failed & ~depleted).alias("kept")))
