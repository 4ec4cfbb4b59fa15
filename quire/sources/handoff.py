"""The hand-off files between the steps of a search: parsed topics (S8) and
ranked lists (J13).

Both are streams without record marks of their own: a parsed topic says how
many ids follow, a ranked list ends at a delimiter line. Neither is read in one
task; places in the stream come from positional ids over all splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import doc_key, topic_number, trim_blanks
from quire.operators.index import TERM_KEYS
from quire.operators.topics import TopicBatch
from quire.session import ensure_checkpoint_dir
from quire.sources.positional import file_positions, ordered_ids

# Fixed value of the ranked-list file: the line that ends a topic's list.
END_OF_LIST = "********"
LINE_BITS = 40            # of a combined position; lists take the bits above


# ---- ranked lists ------------------------------------------------------------

def write_rank_file(run: DataFrame, ids: DataFrame, paths: DataFrame, out: str) -> None:
    """Write the paths of a ranking (``topic_id, doc_id, rank``), a list per
    topic of ``ids`` in ascending order, each ended by the delimiter line.
    Fails if ``out`` exists."""
    lines = run.join(paths.select("doc_id", "path"), "doc_id").select("topic_id", F.col("rank").cast("long").alias("rank"), F.col("path").alias("value"))
    ends = ids.select("topic_id", F.lit((1 << 62)).cast("long").alias("rank"), F.lit(END_OF_LIST).alias("value"))
    lines.unionByName(ends).orderBy("topic_id", "rank").select("value").write.mode("errorifexists").text(out)


def read_rank_file(spark: SparkSession, path: str) -> DataFrame:
    """``list, rank, path``: lists count from 0 and end at delimiter lines, ranks
    count from 1 inside a list; blank lines count for nothing. Lines behind the
    last delimiter are an error."""
    ensure_checkpoint_dir(spark)
    lines = spark.read.text(path).where(trim_blanks("value") != "")
    end = F.when(trim_blanks("value") == END_OF_LIST, 1).otherwise(0)
    # one running total holds the lines before a line and, above them, the delimiters before it
    placed = file_positions(lines.withColumn("_end", end), "_at", weight=F.lit(1).cast("long") + F.col("_end").cast("long") * (1 << LINE_BITS)).checkpoint(eager=True)
    listed = placed.select(F.shiftright("_at", LINE_BITS).cast("int").alias("list"), F.col("_at").bitwiseAND(F.lit((1 << LINE_BITS) - 1)).alias("line"), "value", "_end")
    starts = listed.groupBy("list").agg(F.min("line").alias("first"), F.max("_end").alias("ended"))
    open_lists = starts.where("ended = 0").count()
    if open_lists:
        raise ValueError(f"{path}: the last list is not ended by {END_OF_LIST}")
    return (listed.where("_end = 0").join(starts, "list")
                  .select("list", (F.col("line") - F.col("first") + 1).cast("int").alias("rank"), F.col("value").alias("path")))


def count_lists(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).where(trim_blanks("value") == END_OF_LIST).count()


def read_topic_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``list, number``: the lines of a topic-number file that are not blank."""
    return file_positions(spark.read.text(path).where(trim_blanks("value") != ""), "list").select(F.col("list").cast("int").alias("list"), F.col("value").alias("number"))


def label_rank_file(spark: SparkSession, ranks: str, numbers: str) -> DataFrame:
    """``list, topic_no, rank, doc_key``: ranked lists with the topic numbers of
    the same places. Fails if there are not as many lists as numbers."""
    numbered = read_topic_numbers(spark, numbers)
    lists, topics = count_lists(spark, ranks), numbered.count()
    if lists != topics:
        raise ValueError(f"{lists} ranked lists and {topics} topic numbers")
    return (read_rank_file(spark, ranks).join(numbered, "list")
            .select("list", topic_number("number").alias("topic_no"), "rank", doc_key("path").alias("doc_key")))


# ---- parsed topics -----------------------------------------------------------

def write_topic_terms(batch: TopicBatch, out: str) -> None:
    """Write a batch of vocabulary ids: the number of topics, then per topic (by
    ascending id) its numbers of unigrams and bigrams, the unigrams, the bigrams.
    Fails if ``out`` exists."""
    line = F.when(F.col("n") == 1, F.col("t1").cast("string")).otherwise(F.concat_ws(" ", F.col("t1").cast("string"), F.col("t2").cast("string")))
    counts = batch.grams.groupBy("topic_id").agg(F.count(F.when(F.col("n") == 1, 1)).alias("uni"), F.count(F.when(F.col("n") == 2, 1)).alias("bi"))
    heads = (batch.ids.distinct().join(counts, "topic_id", "left")
                  .select("topic_id", F.lit(0).alias("n"), F.concat_ws(" ", F.coalesce("uni", F.lit(0)), F.coalesce("bi", F.lit(0))).alias("value")))
    total = batch.ids.agg(F.count_distinct("topic_id").cast("string").alias("value")).select(F.lit(None).cast("long").alias("topic_id"), F.lit(0).alias("n"), "value")
    rows = total.unionByName(heads).unionByName(batch.grams.select("topic_id", F.col("n").cast("int").alias("n"), line.alias("value")))
    rows.orderBy(F.col("topic_id").asc_nulls_first(), "n").select("value").write.mode("errorifexists").text(out)


def record_starts(nexts: DataFrame, first: int, count: int) -> DataFrame:
    """``at``: the first ``count`` places that following ``nexts`` (``at, to``)
    from ``first`` passes, by pointer jumping: every round doubles the jumps, so
    their number grows with the logarithm of ``count``."""
    reached = nexts.where(F.col("at") == first).select("at").checkpoint(eager=True)
    jump, steps = nexts, 1
    while steps < count:
        more = reached.join(jump, "at").select(F.col("to").alias("at"))
        reached = reached.unionByName(more).distinct().checkpoint(eager=True)
        steps *= 2
        if steps < count:
            jump = jump.join(jump.select(F.col("at").alias("to"), F.col("to").alias("_to")), "to").select("at", F.col("_to").alias("to")).checkpoint(eager=True)
    return reached.join(nexts.select("at"), "at", "left_semi").orderBy("at").limit(count) if count else reached.limit(0)


def read_topic_terms(spark: SparkSession, path: str) -> TopicBatch:
    """The batch of a parsed-topics file (S8): topic ids are places in the file;
    grams are ids, with ``t2 = -1`` for unigrams. Fails if the file ends early."""
    ensure_checkpoint_dir(spark)
    tokens = F.filter(F.split(trim_blanks("value"), r"\s+"), lambda x: x != "")
    lines = file_positions(spark.read.text(path).withColumn("_t", tokens), "_first", weight=F.size("_t"))
    stream = lines.select("_first", F.posexplode("_t").alias("_i", "_v")).select((F.col("_first") + F.col("_i")).alias("at"), F.col("_v").cast("int").alias("v")).checkpoint(eager=True)
    head = stream.where("at = 0").first()
    topics, size = (head["v"], stream.count()) if head else (0, 0)
    sized = stream.join(stream.select((F.col("at") - 1).alias("at"), F.col("v").alias("bi")), "at").select("at", F.col("v").alias("uni"), "bi")
    nexts = sized.select("at", (F.col("at") + 2 + F.col("uni") + 2 * F.col("bi")).alias("to")).checkpoint(eager=True)
    starts = record_starts(nexts, 1, topics).checkpoint(eager=True)
    records = ordered_ids(starts.join(sized, "at"), ["at"], "topic_id").checkpoint(eager=True)
    found, end = records.agg(F.count(F.lit(1)), F.max(F.col("at") + 2 + F.col("uni") + 2 * F.col("bi"))).first()
    if found != topics or (topics and end > size):
        raise ValueError(f"{path}: {topics} topics announced, {found} found in {size} numbers")
    value = stream.select(F.col("at").alias("_at"), "v")
    uni = (records.where("uni > 0").select("topic_id", F.explode(F.sequence(F.col("at") + 2, F.col("at") + 1 + F.col("uni"))).alias("_at"))
                  .join(value, "_at").select("topic_id", F.lit("0").alias("field"), F.lit(1).alias("n"), F.col("v").alias("t1"), F.lit(-1).alias("t2")))
    begin = F.col("at") + 2 + F.col("uni")
    pairs = records.where("bi > 0").select("topic_id", F.explode(F.sequence(begin, begin + 2 * F.col("bi") - 2, F.lit(2).cast("long"))).alias("_at"))
    second = stream.select((F.col("at") - 1).alias("_at"), F.col("v").alias("t2"))
    bi = pairs.join(value, "_at").join(second, "_at").select("topic_id", F.lit("0").alias("field"), F.lit(2).alias("n"), F.col("v").alias("t1"), "t2")
    grams = uni.unionByName(bi).select("topic_id", "field", *TERM_KEYS)
    return TopicBatch(spark.range(topics).select(F.col("id").alias("topic_id")), grams)
