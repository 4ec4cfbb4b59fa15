"""Measures of a ranking against judgments, and judgments by containment.

Judgments list relevant (topic, document) pairs only. Precision and recall are
taken at a cutoff, average precision over all ranks of the run: the mean, over
a topic's relevant documents, of the precision at their ranks (0 for those not
ranked).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import WORD
from quire.operators.bounded import n_slices, sliced_join
from quire.session import ensure_checkpoint_dir


def average_precision(run: DataFrame, judged: DataFrame, cutoff: int) -> DataFrame:
    """``topic_id, relevant, found, precision, recall, average_precision,
    mean_average_precision`` of every judged topic, also of those that the run
    finds nothing for or does not rank.

    ``run(topic_id, doc_id, rank)``, ``judged(topic_id, doc_id)``. ``found``
    counts the relevant documents up to ``cutoff``."""
    pairs = judged.select("topic_id", "doc_id").distinct()
    totals = pairs.groupBy("topic_id").agg(F.count(F.lit(1)).alias("relevant"))
    hits = run.select("topic_id", "doc_id", "rank").join(pairs, ["topic_id", "doc_id"], "left_semi")
    so_far = F.row_number().over(Window.partitionBy("topic_id").orderBy("rank"))     # at most k hits per topic
    scored = hits.withColumn("at", so_far / F.col("rank")).groupBy("topic_id").agg(
        F.count(F.when(F.col("rank") <= cutoff, 1)).alias("found"), F.sum("at").alias("sum"))
    each = (totals.join(scored, "topic_id", "left")
                  .select("topic_id", "relevant", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("sum", F.lit(0.0)).alias("sum")))
    each = each.select("topic_id", "relevant", "found", (F.col("found") / F.lit(cutoff)).alias("precision"),
                       (F.col("found") / F.col("relevant")).alias("recall"), (F.col("sum") / F.col("relevant")).alias("average_precision"))
    return each.withColumn("mean_average_precision", each.select(F.avg("average_precision")).scalar())


def containing(docs: DataFrame, topics: DataFrame) -> DataFrame:
    """``topic_id, doc_id`` of the documents (``doc_id, text``) that hold a
    topic's whole text (``topic_id, text``).

    A containment join: every topic is anchored on the one of its inner words
    that fewest documents have, documents meet topics on their distinct words,
    and the pairs that share an anchor are tested on the texts. Inner words
    stand whole in a document that holds the topic, so no pair is lost, and no
    topics x documents product is formed. A text under three words has no
    inner word; such topics are refused."""
    ensure_checkpoint_dir(docs.sparkSession)
    topics = topics.where(F.length("text") > 0).select("topic_id", F.col("text").alias("wanted"))
    # the first and last word of a topic may be part of a longer word in a document
    tokens = WORD.sequence(F.col("wanted"))
    inner = F.array_distinct(F.slice(tokens, 2, F.greatest(F.size(tokens) - 2, F.lit(0))))
    short = topics.where(F.size(inner) == 0).count()
    if short:
        raise ValueError(f"{short} topics have under three words and no anchor")
    words = topics.select("topic_id", "wanted", F.explode(inner).alias("word"))
    distinct = words.select("word").distinct()
    held = docs.select("doc_id", F.explode(F.array_distinct(WORD.sequence(F.coalesce(F.col("text"), F.lit(""))))).alias("word"))
    held = sliced_join(held, distinct, ["word"], n_slices(distinct, ["word"]), "left_semi").checkpoint(eager=True)
    df = held.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    rarest = F.row_number().over(Window.partitionBy("topic_id").orderBy("df", "word"))
    anchored = (words.join(df, "word", "left").withColumn("df", F.coalesce("df", F.lit(0))).withColumn("at", rarest)
                     .where(F.col("at") == 1).select("topic_id", "word"))
    met = sliced_join(held, anchored, ["word"], n_slices(anchored, ["word"])).select("topic_id", "doc_id")
    found = (met.join(topics, "topic_id").join(docs.select("doc_id", "text"), "doc_id").where(F.contains("text", "wanted")).select("topic_id", "doc_id"))
    return found.distinct()
