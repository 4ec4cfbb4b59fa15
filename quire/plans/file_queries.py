"""Queries over the file formats: each writes a driver table in the format
under the session's shared folder and runs the library's reader on it.

The driver tables stand in for files that do not exist here; the readers and
writers run unchanged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.evaluation import containing
from quire.operators.index import Index, vocab_postings
from quire.operators.topics import TopicBatch, fields_from_table
from quire.plans.search import search
from quire.session import ensure_checkpoint_dir
from quire.sources import files as R
from quire.sources import handoff as H
from quire.sources.positional import ordered_ids
from quire.sources.sinks import write_run
from quire.sources.tables import table

K = 100
COLLECTION = "/data/coll"      # a collection folder whose last part some listed paths repeat


def folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-files-{uuid.uuid4().hex}/{name}"


def _written(spark: SparkSession, lines: DataFrame, order: list[str], name: str) -> str:
    """``value`` written as lines in ``order``."""
    path = folder(spark, name)
    lines.orderBy(*order).select("value").write.text(path)
    return path


def _xml(spark: SparkSession, rows: DataFrame, root: str, row: str) -> str:
    """``rows`` as well-formed XML files with a ``root`` element each."""
    path = folder(spark, root)
    rows.write.format("xml").option("rootTag", root).option("rowTag", row).save(path)
    return path


def plain(col: str) -> F.Column:
    """Text without the characters that XML cannot hold."""
    return F.regexp_replace(col, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def _documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents", ["doc_id", "text", "source", "n_chars"])


def _paths(spark, sf) -> DataFrame:
    """``doc_id, path``: ids are positions in the file list."""
    docs = _documents(spark, sf).select("doc_id", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"))
    return ordered_ids(docs, ["doc_id"], "at").select(F.col("doc_id").alias("own_id"), F.col("at").alias("doc_id"), "path")


def _vocab(spark, sf) -> DataFrame:
    """Words of two documents or more, in order, behind an encoding line."""
    words = Index.from_documents(table(spark, sf, "documents"), "word", (1,)).terms.where("n = 1 AND df >= 2").select(F.col("t1").alias("value"))
    lines = words.unionByName(spark.range(1).select(F.lit("").alias("value")))
    return R.read_vocab(spark, _written(spark, lines.withColumn("value", F.when(F.col("value") == "", " utf8").otherwise(F.col("value"))), ["value"], "vocab"))


def q_read_vocab(spark, sf):
    return _vocab(spark, sf)


def q_read_file_list(spark, sf):
    return R.read_file_list(spark, _written(spark, _paths(spark, sf).withColumnRenamed("path", "value"), ["doc_id"], "list"))


def q_read_doc_lengths(spark, sf):
    lines = _documents(spark, sf).select("doc_id", F.col("n_chars").cast("string").alias("value"))
    return R.read_doc_lengths(spark, _written(spark, lines, ["doc_id"], "lengths"))


def q_read_inverted_file(spark, sf):
    """Postings of the benchmark's texts as vocabulary ids, a header per term."""
    bench = table(spark, sf, "benchmark")
    posted = vocab_postings(bench, _vocab(spark, sf), "word", "item_id", "text").checkpoint(eager=True)
    heads = posted.groupBy("n", "t1", "t2").agg(F.count(F.lit(1)).alias("df")).select("n", "t1", "t2", F.lit(None).cast("long").alias("doc_id"),
                                                                                      F.concat_ws(" ", "t1", "t2", "df").alias("value"))
    lines = heads.unionByName(posted.select("n", "t1", "t2", "doc_id", F.concat_ws(" ", "doc_id", "tf").alias("value")))
    return R.read_inverted_file(spark, _written(spark, lines, ["n", "t1", "t2", "doc_id"], "inverted"))


def q_read_topics(spark, sf):
    """Topics under a root of another name."""
    rows = table(spark, sf, "benchmark").orderBy("item_id").select(
        F.concat(F.lit(" No "), F.lpad(F.col("item_id").cast("string"), 3, "0")).alias("number"),
        F.regexp_replace(plain("text"), r"[\r\n]+", " ").alias("title"), F.col("item_id").cast("string").alias("question"))
    topics = R.read_topics(spark, _xml(spark, rows, "topics", "topic"))
    return topics.select("topic_pos", T.topic_number("number").alias("topic_no"), F.length(F.get("title", F.lit(0))).cast("long").alias("title_len"),
                         F.get("question", F.lit(0)).alias("question"))


def q_read_doc_xml(spark, sf):
    """Documents as XML, a paragraph per line of text; lengths of what is read."""
    rows = _documents(spark, sf).select(F.col("doc_id").cast("string").alias("title"), F.struct(F.split(F.replace(plain("text"), F.lit("\r"), F.lit("")), "\n").alias("p")).alias("text"))
    read = R.read_doc_xml(spark, _xml(spark, rows, "docs", "doc"))
    lengths = F.aggregate(F.transform("paragraphs", lambda p: F.coalesce(F.length(T.strip_control(p)), F.lit(0)).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    return read.select(F.col("title").cast("long").alias("doc_id"), F.size("paragraphs").alias("n_paragraphs"), lengths.alias("n_chars"))


def q_read_qrels(spark, sf):
    judged = containing(table(spark, sf, "documents"), fields_from_table(table(spark, sf, "benchmark"), "item_id", "text").select("topic_id", "text"))
    lines = judged.select("topic_id", "doc_id", F.concat_ws(" ", F.lpad(F.col("topic_id").cast("string"), 3, "0"), F.col("doc_id").cast("string")).alias("value"))
    return R.read_qrels(spark, _written(spark, lines, ["topic_id", "doc_id"], "qrels"))


def q_read_topic_terms(spark, sf):
    """Benchmark topics as vocabulary ids, through the parsed-topics file."""
    batch = TopicBatch.from_vocabulary(fields_from_table(table(spark, sf, "benchmark"), "item_id", "text"), _vocab(spark, sf), T.WORD)
    path = folder(spark, "parsed")
    H.write_topic_terms(TopicBatch(batch.ids, batch.grams.checkpoint(eager=True)), path)
    return H.read_topic_terms(spark, path).terms()


def _run(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    bench = table(spark, sf, "benchmark")
    run = search(table(spark, sf, "documents"), TopicBatch.from_table(bench, "item_id", "text"), k=K).checkpoint(eager=True)
    numbers = bench.select(F.col("item_id").alias("topic_id"), F.lpad(F.col("item_id").cast("string"), 3, "0").alias("number"))
    return run, numbers, _paths(spark, sf).select(F.col("own_id").alias("doc_id"), "path")


def q_write_run(spark, sf):
    """The lines of the written run, with their places."""
    run, numbers, paths = _run(spark, sf)
    out = folder(spark, "run")
    write_run(run, numbers, paths, out)
    return R.read_token_list(spark, out, "token", "at")


def q_label_rank_file(spark, sf):
    """The ranking through the ranked-list file, labelled by place."""
    run, numbers, paths = _run(spark, sf)
    out = folder(spark, "ranks")
    H.write_rank_file(run, numbers.select("topic_id"), paths, out)
    lines = _written(spark, numbers.withColumnRenamed("number", "value"), ["topic_id"], "numbers")
    return H.label_rank_file(spark, out, lines).select("topic_no", "rank", "doc_key")


def q_doc_path(spark, sf):
    """Listed paths, some of which begin with the collection's own name."""
    listed = F.concat(F.when(F.col("doc_id") % 3 == 0, "coll/").otherwise(""), F.concat_ws("/", "source", F.col("doc_id").cast("string")))
    return _documents(spark, sf).select("doc_id", T.doc_path(COLLECTION, listed).alias("path"))


def q_search_saved_index(spark, sf):
    """Top documents from a saved index, by block bounds."""
    path = folder(spark, "index")
    Index.from_documents(table(spark, sf, "documents"), "word").save(path)
    return search(Index.load(spark, path), TopicBatch.from_table(table(spark, sf, "benchmark"), "item_id", "text"), k=K)


FILE_QUERIES = {q.__name__[2:]: q for q in (
    q_read_vocab, q_read_file_list, q_read_doc_lengths, q_read_inverted_file, q_read_topics, q_read_doc_xml, q_read_qrels,
    q_read_topic_terms, q_write_run, q_label_rank_file, q_doc_path, q_search_saved_index)}
