"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents, in an order shuffled by hash, form one stream of
words that is cut into equal blocks. Slot i of the mix falls on the
golden-ratio point frac(i * phi), which picks a source through the cumulative
target weights; the slots of a source are ranked and rank r takes the block
r mod (number of blocks). The schedule keeps every source near its share in
any stretch of the mix, and no block is taken more than twice.

Defined results: null or word-less texts have size 0 and are not taken; null
sources form one source of their own, last in order; repeated rows are
documents of their own; extra columns are ignored; an empty table gives an
empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.prefix import with_start
from quire.llm.scratch import Scratch
from quire.sources.positional import ordered_ids

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)     # of the sources in order, repeating
SHARE = 1.5                   # size of the mix over the size of all documents
LIMIT = 2                     # most passes over a source
BLOCK_WORDS = 2048            # largest block
LEAST_BLOCKS = 512            # a source has about as many blocks at least, down to one word each
GOLDEN = 0.6180339887498949
STREAM_BITS = 12              # a source's stream is ordered in 2**12 hash buckets
SLOT_BITS = 14                # slots are ranked in runs of 2**14


def sized(docs: DataFrame) -> DataFrame:
    """``row, doc_id, src, size, h1, h2``: ``src`` orders sources by code point,
    null last; the hashes give the shuffled order."""
    src = F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce(F.col("source"), F.lit("")))
    row = F.col("row") if "row" in docs.columns else F.monotonically_increasing_id().alias("row")
    return docs.select(row, F.col("doc_id").cast("long"), src.alias("src"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64("doc_id", F.length("text")).alias("h1"), F.xxhash64("text", "doc_id").alias("h2"))


def targets(rows: DataFrame, scratch: Scratch, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Per source ``src, pos, source_size, target``: the shares of ``share``
    times all sizes by weight, each at most ``LIMIT`` times its source; what is
    over the limit is shared again by weight until none is above."""
    sources = ordered_ids(rows.groupBy("src").agg(F.sum("size").alias("source_size")), ["src"], "pos")
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = scratch.keep(sources.withColumn("weight", F.get(cycle, (F.col("pos") % len(weights)).cast("int"))), "sources")
    want = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > F.col("source_size") * LIMIT
        got = sources.agg(F.sum(full.cast("long")).alias("n"),
                          F.sum(F.when(full, F.col("source_size") * LIMIT)).alias("taken"),
                          F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if got["n"] == capped or not got["open"]:
            break
        capped, level = got["n"], (want - (got["taken"] or 0)) / got["open"]
    return sources.select("src", "pos", "source_size",
                          F.least(F.col("weight") * F.lit(level), F.col("source_size").cast("double") * LIMIT).alias("target"))


def blocks(goals: DataFrame) -> DataFrame:
    """Adds ``block_words`` and ``n_blocks`` of each source."""
    words = F.least(F.lit(BLOCK_WORDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / LEAST_BLOCKS))).cast("long")
    return (goals.withColumn("block_words", words)
                 .withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block_words")).cast("long")))


def schedule(goals: DataFrame, spark, scratch: Scratch) -> DataFrame:
    """``slot, src, rank, block``: the mix in order. ``goals`` is ``blocks()``."""
    goals = scratch.keep(with_start(goals.withColumn("need", F.col("target") / F.col("block_words"))
                                         .withColumn("run", F.expr("pos div 4096")), [], "run", ["pos"], "need", "lo"), "goals")
    total, n = goals.agg(F.sum("need"), F.count(F.lit(1))).first()
    slots = -int(-(total or 0.0) // 1)
    cells = max(64, 4 * n)
    if not slots:
        total = 1.0
    lo, hi = F.col("lo") / F.lit(total), (F.col("lo") + F.col("need")) / F.lit(total)
    spans = (goals.where("need > 0").withColumn("from", lo).withColumn("to", hi)
                  .withColumn("cell", F.explode(F.sequence(F.floor(F.col("from") * cells), F.floor(F.least(F.col("to"), F.lit(1.0)) * cells)))))
    point = F.col("slot") * F.lit(GOLDEN)
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", point - F.floor(point)) \
                  .withColumn("cell", F.floor(F.col("point") * cells))
    placed = (points.join(spans.select("cell", "src", "from", "to", "n_blocks"), "cell")
                    .where((F.col("point") >= F.col("from")) & (F.col("point") < F.col("to")))
                    .select("slot", "src", "n_blocks", F.lit(1).cast("long").alias("one"), F.shiftright("slot", SLOT_BITS).alias("run")))
    ranked = with_start(scratch.keep(placed, "slots"), ["src"], "run", ["slot"], "one", "rank")
    return (ranked.where(F.col("rank") < F.col("n_blocks") * LIMIT)
                  .select("slot", "src", "rank", (F.col("rank") % F.col("n_blocks")).alias("block")))


def placed_rows(rows: DataFrame) -> DataFrame:
    """Adds ``start``: a document's first word in its source's stream."""
    dealt = rows.withColumn("bucket", F.shiftright("h1", 64 - STREAM_BITS))
    return with_start(dealt, ["src"], "bucket", ["h1", "h2", "doc_id"], "size", "start").select("row", "src", "start", "doc_id", "size")


def streams(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``src, start, doc_id, size, block, skip, words``: the part of every
    document that lies in each block of its source's stream."""
    placed = rows.where("size > 0").join(goals.select("src", "block_words"), "src")
    first, last = F.expr("start div block_words"), F.expr("(start + size - 1) div block_words")
    parts = placed.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("block") * F.col("block_words"))
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("block_words"))
    return parts.select("src", "start", "doc_id", "size", "block", (begin - F.col("start")).alias("skip"), (end - begin).alias("words"))


def mix(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The placed rows, the goals per source, and the mix: one row per slot and
    document in its block (``slot, src, start, doc_id, size, skip, words``)."""
    rows = scratch.keep(sized(docs), "sized")
    goals = scratch.keep(blocks(targets(rows, scratch)), "targets")
    rows = scratch.keep(placed_rows(rows), "placed")
    plan = schedule(goals, docs.sparkSession, scratch)
    mixed = streams(rows, goals).join(plan.select("slot", "src", "block"), ["src", "block"]) \
                                .select("slot", "src", "start", "doc_id", "size", "skip", "words")
    return rows, goals, mixed


def taken_words(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``row, doc_id, size, source_size, target, taken`` for every document."""
    rows, goals, mixed = mix(docs, scratch)
    got = mixed.groupBy("src", "start").agg(F.sum("words").alias("taken"))
    with_words = rows.where("size > 0").join(got, ["src", "start"], "left")
    empty = rows.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (with_words.unionByName(empty, allowMissingColumns=True).join(goals.select("src", "source_size", "target"), "src")
                      .select("row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))
