"""Top-k per topic with zero fill.

Every listed document has a score for every topic, 0 when nothing matches,
and zeros may fill a topic's top k (ties broken by ascending doc_id). The
matched scores are sparse and are ranked first: documents are dealt out by
id, so ``row_number() <= k`` keeps k rows per topic and partition before any
(topic, document) row is shuffled. Zeros are added to that short list.

An unmatched document reaches a topic's top k only as one of the first k
unmatched documents by id. With non-negative scores these are among the first
k documents. With negative scores they may stand anywhere, and are found by
counting gaps: documents are numbered by id (slots), the i-th matched slot of
a topic has (slot - i) unmatched slots before it, and so the j-th unmatched
slot is j plus the number of matched slots whose gap count is at most j. Slots
are counted in runs first, so only runs that begin before the k-th gap are
looked at, and no window holds more than one run of a topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import ensure_checkpoint_dir
from quire.sources.positional import ordered_ids

RUN_SLOTS = 1 << 16     # slots that a window of one topic holds


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """``row_number`` over (topic, score desc, doc_id asc) <= k."""
    w = Window.partitionBy("topic_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return (scores.withColumn("rank", F.row_number().over(w))
                  .where(F.col("rank") <= k)
                  .select("topic_id", "doc_id", "score", F.col("rank").cast("int")))


def first_docs(listed: DataFrame, width: int) -> DataFrame:
    """The ``width`` smallest doc ids with their position ``slot`` (0-based).

    A bounded top-``width`` (TakeOrderedAndProject), then numbering of those
    ``width`` rows only."""
    head = listed.select("doc_id").orderBy("doc_id").limit(width)
    return head.withColumn("slot", F.row_number().over(Window.orderBy("doc_id")) - 1)


def first_gaps(topic_ids: DataFrame, numbered: DataFrame, matched: DataFrame, k: int) -> DataFrame:
    """``topic_id, doc_id`` of each topic's first ``k`` documents by slot that are
    not among its ``matched`` (``topic_id, doc_id``, each pair once). The number
    of jobs does not depend on the documents."""
    placed = (matched.join(numbered, "doc_id")
                     .select("topic_id", F.col("slot").cast("long").alias("slot"), F.expr(f"slot div {RUN_SLOTS}").alias("run")).checkpoint(eager=True))
    earlier = Window.partitionBy("topic_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (placed.groupBy("topic_id", "run").agg(F.count(F.lit(1)).alias("n"))
                  .select("topic_id", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
                  .where(F.col("run") * RUN_SLOTS - F.col("before") < k))
    inside = Window.partitionBy("topic_id", "run").orderBy("slot")
    gaps = (placed.join(runs, ["topic_id", "run"])
                  .select("topic_id", (F.col("slot") - F.col("before") - F.row_number().over(inside) + 1).alias("gap"))
                  .where(F.col("gap") < k).groupBy("topic_id", "gap").agg(F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy("topic_id").orderBy("gap").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = topic_ids.select("topic_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long"))).alias("gap"))
    slots = (wanted.join(gaps, ["topic_id", "gap"], "left")
                   .select("topic_id", (F.col("gap") + F.sum(F.coalesce("n", F.lit(0))).over(upto)).alias("slot")))
    return slots.join(numbered, "slot").select("topic_id", "doc_id")


def ranked_with_zeros(scores: DataFrame, topic_ids: DataFrame, listed: DataFrame, k: int, nonnegative: bool) -> DataFrame:
    """Top ``k`` of all listed documents per topic. ``scores`` holds the matched
    pairs; ``nonnegative`` says that no score can be below 0.

    The matched pairs are ranked and written once (``k`` rows per topic). Zeros
    concern the topics with fewer than ``k`` positive scores only; without
    negative scores all matched pairs of such a topic stand in its short list,
    so the scores are not computed again."""
    ensure_checkpoint_dir(topic_ids.sparkSession)
    matched = scores.where(F.col("score") != 0)
    if not nonnegative:
        matched = matched.checkpoint(eager=True)
    top = top_k(matched, k).drop("rank").checkpoint(eager=True)
    filled = top.where(F.col("score") > 0).groupBy("topic_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    lacking = topic_ids.join(filled, "topic_id", "left_anti").select("topic_id")
    score = F.lit(0.0).alias("score")
    if nonnegative:
        numbered = F.broadcast(first_docs(listed, k))
        slots = lacking.select("topic_id", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("slot"))
        first = slots.join(numbered, "slot").select("topic_id", "doc_id")
        zeros = first.join(top.select("topic_id", "doc_id"), ["topic_id", "doc_id"], "left_anti").select("topic_id", "doc_id", score)
    else:
        numbered = ordered_ids(listed.select("doc_id").distinct(), ["doc_id"], "slot").select("doc_id", "slot").checkpoint(eager=True)
        zeros = first_gaps(lacking, numbered, matched.join(lacking, "topic_id", "left_semi"), k).select("topic_id", "doc_id", score)
    # a matched pair that scores exactly 0 also stands among the zeros
    return top_k(top.unionByName(zeros), k)
