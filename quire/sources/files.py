"""Readers for the retrieval file formats.

All are Spark file sources plus DataFrame operations; positions in a file
come from :mod:`quire.sources.positional`, never from a single-partition
window. A missing input path raises Spark's path-not-found error (S12).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import BLANK_CLASS, CONCEPT_DELIMITER, Profile, cleaned_length, topic_number, trim_blanks
from quire.operators.topics import TopicBatch, split_concepts
from quire.sources.positional import file_positions, split_tagged

WS_SPLIT = BLANK_CLASS + "+"


def _tokens(line) -> F.Column:
    """Whitespace-separated tokens of a line (none for a blank line)."""
    return F.array_remove(F.split(trim_blanks(line), WS_SPLIT), "")


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``term STRING, term_id INT`` (S1): one term per line, id = line number
    from 0, text trimmed. A duplicate term keeps its last line; line 0 (an
    encoding line) would be id 0, which means 'unknown', so it is dropped."""
    lines = file_positions(spark.read.text(path), "term_id")
    return (lines.select(trim_blanks("value").alias("term"), "term_id")
                 .groupBy("term").agg(F.max("term_id").cast("int").alias("term_id"))
                 .where((F.col("term_id") > 0) & (F.col("term") != "")))


def read_token_list(spark: SparkSession, path: str, name: str, id_name: str) -> DataFrame:
    """Whitespace-separated tokens numbered from 0 in file order."""
    lines = spark.read.text(path).withColumn("_t", _tokens(F.col("value")))
    numbered = file_positions(lines, "_first", weight=F.size("_t"))
    return numbered.select(F.posexplode("_t").alias("_p", name), "_first") \
                   .select((F.col("_first") + F.col("_p")).alias(id_name), name)


def read_file_list(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id BIGINT, path STRING`` (S2): whitespace-separated paths, id =
    position from 0."""
    return read_token_list(spark, path, "path", "doc_id")


def read_doc_lengths(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id BIGINT, doc_len INT`` (S7): integers in file order."""
    return (read_token_list(spark, path, "v", "doc_id")
            .select("doc_id", F.col("v").cast("int").alias("doc_len")))


POSTING_COLS = ["n", "t1", "t2", "doc_id", "tf", "df"]


def read_inverted_file(spark: SparkSession, path: str) -> DataFrame:
    """``n, t1, t2, doc_id, tf, df`` (S3).

    The file is a sequence of blocks: a header line ``t1 t2 N`` (``t2 =
    -1``: unigram) followed by ``N`` lines ``doc_id count``. Every posting
    line takes the last header before it: inside a split by a running
    ``last(ignorenulls)``, and for lines before a split's first header from
    the last header of the preceding splits (one row per split). ``df`` is
    the header's ``N``; :func:`inverted_file_errors` checks it against the
    postings actually present.
    """
    raw = split_tagged(spark.read.text(path))
    tok = raw.withColumn("_t", _tokens(F.col("value")))
    n_tok = F.size("_t")
    hdr = F.when(n_tok == 3, F.struct(F.col("_t")[0].cast("int").alias("t1"),
                                      F.col("_t")[1].cast("int").alias("t2"),
                                      F.col("_t")[2].cast("long").alias("df")))
    tok = tok.withColumn("_h", hdr)
    in_split = Window.partitionBy("_file", "_block").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    tok = tok.withColumn("_h_in", F.last("_h", ignorenulls=True).over(in_split))
    last_of_split = (tok.where(F.col("_h").isNotNull()).groupBy("_file", "_block")
                        .agg(F.max_by("_h", "_mid").alias("_h_last")))
    splits = tok.select("_file", "_block").distinct().join(last_of_split, ["_file", "_block"], "left")
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = splits.select("_file", "_block",
                          F.last("_h_last", ignorenulls=True).over(before).alias("_h_prev"))
    rows = tok.where(n_tok == 2).join(carry, ["_file", "_block"], "left")
    h = F.coalesce(F.col("_h_in"), F.col("_h_prev"))
    return rows.select(F.when(h["t2"] == -1, F.lit(1)).otherwise(F.lit(2)).alias("n"),
                       h["t1"].alias("t1"), h["t2"].alias("t2"),
                       F.col("_t")[0].cast("long").alias("doc_id"),
                       F.col("_t")[1].cast("long").alias("tf"),
                       h["df"].alias("df"))


def inverted_file_errors(postings: DataFrame) -> DataFrame:
    """Terms whose header count differs from the postings read for them,
    and postings that precede any header."""
    orphans = postings.where(F.col("t1").isNull()).select(
        F.lit("posting before any header").alias("error"), "n", "t1", "t2")
    counts = (postings.where(F.col("t1").isNotNull()).groupBy("n", "t1", "t2", "df")
                      .agg(F.count(F.lit(1)).alias("read"))
                      .where(F.col("read") != F.col("df"))
                      .select(F.lit("header count differs").alias("error"), "n", "t1", "t2"))
    return orphans.unionByName(counts)


TOPIC_FIELDS = ("title", "question", "narrative", "concepts")
TOPIC_SCHEMA = T.StructType([T.StructField("topic", T.ArrayType(T.StructType(
    [T.StructField(c, T.ArrayType(T.StringType())) for c in ("number", *TOPIC_FIELDS)])))])


def root_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files' root elements: the first start tag of every file.
    There are no more of them than files."""
    lines = split_tagged(spark.read.text(path))
    tag = F.regexp_extract(F.regexp_replace("value", r"<!--.*?-->", ""), r"<([\p{L}_:][^\s/>]*)", 1)
    first = lines.select("_file", "_block", "_mid", tag.alias("tag")).where("tag <> ''").groupBy("_file").agg(F.min_by("tag", F.struct("_block", "_mid")).alias("root"))
    return sorted(r["root"] for r in first.select("root").distinct().collect())


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """``topic_pos, number`` and, as arrays of every element of the name,
    ``title, question, narrative, concepts`` (S4), from the ``topic`` children
    of the root element, whatever its name; a ``topic`` further down is not
    one. A missing number reads as ''. Files of several roots are refused, and
    so is a root without topics."""
    names = root_names(spark, path)
    if len(names) != 1:
        raise ValueError(f"{path}: one root element expected, found {names}")
    roots = (spark.read.format("xml").option("rowTag", names[0]).option("ignoreSurroundingSpaces", "false")
                  .schema(TOPIC_SCHEMA).load(path))
    if roots.where(F.size("topic") > 0).isEmpty():
        raise ValueError(f"{path}: the root element {names[0]} has no topic")
    roots = file_positions(roots, "_first", weight=F.coalesce(F.size("topic"), F.lit(0)))
    each = roots.select("_first", F.posexplode("topic").alias("_at", "t"))
    return each.select((F.col("_first") + F.col("_at")).alias("topic_pos"),
                       F.coalesce(F.get("t.number", F.lit(0)), F.lit("")).alias("number"),
                       *[F.coalesce(F.col(f"t.{c}"), F.array().cast("array<string>")).alias(c) for c in TOPIC_FIELDS])


def topic_fields(topics: DataFrame, delimiter: str = CONCEPT_DELIMITER) -> DataFrame:
    """``topic_id, field, text``: every title, question and narrative element as
    a field of its own, and every concept entry as one more (T9, T10)."""
    def fields(name):
        return topics.select(F.col("topic_pos").alias("topic_id"), F.posexplode(name).alias("_at", "text")) \
                     .select("topic_id", F.concat_ws(".", F.lit(name), F.col("_at").cast("string")).alias("field"),
                             F.coalesce("text", F.lit("")).alias("text"))
    plain = fields("title").unionByName(fields("question")).unionByName(fields("narrative"))
    return plain.unionByName(split_concepts(fields("concepts"), delimiter))


def topic_batch_from_xml(spark: SparkSession, path: str, profile: Profile | str = "char",
                         delimiter: str = CONCEPT_DELIMITER, vocab: DataFrame | None = None) -> tuple[TopicBatch, DataFrame]:
    """A :class:`TopicBatch` (ids = 0-based topic positions) and the topic
    numbers ``topic_id, number, topic_no`` of a topic file. With ``vocab``
    (``term, term_id``) the terms are vocabulary ids, as inverted files have."""
    topics = read_topics(spark, path)
    fields = topic_fields(topics, delimiter)
    ids = topics.select(F.col("topic_pos").alias("topic_id"))
    batch = TopicBatch.from_fields(fields, profile, ids=ids) if vocab is None else \
        TopicBatch.from_vocabulary(fields, vocab, profile, ids)
    numbers = topics.select(F.col("topic_pos").alias("topic_id"), "number",
                            topic_number("number").alias("topic_no"))
    return batch, numbers


DOC_SCHEMA = T.StructType([T.StructField("title", T.StringType()),
                           T.StructField("text", T.StructType([T.StructField("p", T.ArrayType(T.StringType()))]))])


def read_doc_xml(spark: SparkSession, path: str) -> DataFrame:
    """``path, title, paragraphs`` (S6) from document XML (``doc/title``,
    ``doc/text/p``), one row per ``doc`` element."""
    df = (spark.read.format("xml").option("rowTag", "doc").option("ignoreSurroundingSpaces", "false")
               .schema(DOC_SCHEMA).load(path))
    return df.select(F.col("_metadata.file_path").alias("path"), "title",
                     F.coalesce(F.col("text.p"), F.array().cast("array<string>")).alias("paragraphs"))


def doc_xml_lengths(docs: DataFrame, root: str = "") -> DataFrame:
    """``path, title_len, text_len, doc_len`` (T15) of ``read_doc_xml`` rows:
    cleaned lengths of the title and of all paragraphs. ``path`` is relative
    to ``root`` (T14)."""
    title = F.coalesce(cleaned_length("title"), F.lit(0).cast("long"))
    text = F.aggregate(F.transform("paragraphs", lambda s: F.coalesce(cleaned_length(s), F.lit(0).cast("long"))),
                       F.lit(0).cast("long"), lambda a, b: a + b)
    path = F.col("path") if not root else F.regexp_replace("path", F.concat(F.lit("^(file:)?/*"), F.lit(re.escape(root.strip("/"))), F.lit("/")), F.lit(""))
    return (docs.select(path.alias("path"), title.alias("title_len"), text.alias("text_len"))
                .withColumn("doc_len", F.col("title_len") + F.col("text_len")))


QRELS_SCHEMA = "topic_no STRING, doc_key STRING"


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """``topic_no, doc_key`` (S9): relevant pairs, one "topic doc" per line."""
    return spark.read.csv(path, sep=" ", schema=QRELS_SCHEMA)
