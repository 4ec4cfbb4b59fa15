"""Run output: labelling ranked lists and writing run files.

A run file has one line ``<topic number> <document key>`` per ranked
document, topics in input order, documents in rank order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import doc_key, topic_number
from quire.operators.bounded import n_slices, sliced_join


def _check_unique(df: DataFrame, key: str, label: str, what: str) -> None:
    repeated = df.groupBy(label).agg(F.count_distinct(key).alias("n")).where((F.col("n") > 1) & F.col(label).isNotNull()).count()
    if repeated:
        raise ValueError(f"{repeated} {what} stand for more than one {key}; run not labelled")


def label_run(run: DataFrame, numbers: DataFrame, paths: DataFrame) -> DataFrame:
    """Attach topic numbers and document keys to a ranking.

    ``run(topic_id, doc_id, rank, ...)``, ``numbers(topic_id, number)``,
    ``paths(doc_id, path)``. Labels are joined by id, never by position, and
    only the paths of ranked documents are looked up. Fails, naming the
    counts, if a ranked topic has no number, a ranked document has no path,
    or a number or path is used twice.
    """
    run = run.select("topic_id", "doc_id", F.col("rank").cast("int"))
    wanted = run.select("doc_id").distinct()
    ranked_paths = sliced_join(paths.select("doc_id", "path"), wanted, ["doc_id"], n_slices(wanted, []), "left_semi")
    labeled = (run.join(numbers.select("topic_id", topic_number("number").alias("topic_no")), "topic_id", "left")
                  .join(ranked_paths.select("doc_id", doc_key("path").alias("doc_key")), "doc_id", "left"))
    _check_unique(numbers.select("topic_id", topic_number("number").alias("topic_no")), "topic_id", "topic_no", "topic numbers")
    _check_unique(ranked_paths, "doc_id", "path", "paths")
    n_topics, n_docs = labeled.agg(F.count_distinct(F.when(F.col("topic_no").isNull(), F.col("topic_id"))),
                                   F.count_distinct(F.when(F.col("doc_key").isNull(), F.col("doc_id")))).first()
    if n_topics or n_docs:
        raise ValueError(f"{n_topics} ranked topics without a number and {n_docs} ranked documents without a path; run not labelled")
    return labeled.select("topic_id", "topic_no", "rank", "doc_key")


def write_run(run: DataFrame, numbers: DataFrame, paths: DataFrame, out: str,
              topic_order: DataFrame | None = None) -> None:
    """Write ``<topic number> <doc key>`` lines, topics in ``topic_order``
    (``topic_id, topic_pos``; default: by topic_id), documents by rank.

    Fails as :func:`label_run` does, if a ranked topic has no place in
    ``topic_order``, and (Spark's default save mode) if ``out`` already
    exists - outputs are never overwritten (S11).
    """
    labeled = label_run(run, numbers, paths)
    if topic_order is None:
        labeled = labeled.withColumn("topic_pos", F.col("topic_id"))
    else:
        labeled = labeled.join(topic_order.select("topic_id", "topic_pos"), "topic_id", "left")
        unplaced = labeled.where(F.col("topic_pos").isNull()).select("topic_id").distinct().count()
        if unplaced:
            raise ValueError(f"{unplaced} ranked topics without a place in the order; run not written")
    lines = labeled.select(F.concat_ws(" ", "topic_no", "doc_key").alias("value"), "topic_pos", "rank")
    lines.orderBy("topic_pos", "rank").select("value").write.mode("errorifexists").text(out)
