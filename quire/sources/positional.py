"""Positional ids without a global single-partition window.

Rows get consecutive ids in a defined order: per input partition (or file
split) the rows are counted, a running sum over those counts - one small
row per partition - gives each partition its offset, and the offset plus
the row's place inside its partition is the id. Only the per-partition
counts ever meet in one place; a split is never larger than the reader's
split size, so windows over one split stay bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import ensure_checkpoint_dir

ROW_BITS = 33  # monotonically_increasing_id: partition id above bit 33


def ordered_ids(df: DataFrame, order_cols: list[str], name: str, start: int = 0) -> DataFrame:
    """Add ``name``: consecutive ids ``start, start+1, ...`` in ``order_cols``
    order (a distributed sort, then partition offsets).

    The sorted rows are checkpointed before they are numbered: the row ->
    partition assignment of a range sort comes from sampling, so both uses
    of it (counting and numbering) must read one materialized copy.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (df.orderBy(*order_cols)
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    return _number(tagged, F.shiftright("_mid", ROW_BITS), name, start)


def split_tagged(lines: DataFrame) -> DataFrame:
    """Adds ``_file``, ``_block`` (the split's byte offset) and ``_mid``
    (increasing in file order within a split) to a file-source DataFrame."""
    return lines.select("*", F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_mid"))


def file_positions(lines: DataFrame, name: str, start: int = 0, weight=None) -> DataFrame:
    """Add ``name``: the running position of each row over the whole input
    (files in name order, lines in file order), for a DataFrame read with
    ``spark.read.text`` or any file source.

    ``weight`` (a column, default 1) says how many positions a row takes;
    ``name`` is then the position of its first one (rows of weight 0 take
    none). The running sum inside a split is a window over that split only;
    the offsets of files, and of the splits of a file, come from one small
    row per file or split.
    """
    w_col = F.lit(1) if weight is None else weight
    tagged = split_tagged(lines).withColumn("_w", w_col.cast("long"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    split_w = before(Window.partitionBy("_file", "_block").orderBy("_mid"))
    inside = tagged.withColumn("_in", F.coalesce(F.sum("_w").over(split_w), F.lit(0)))
    per_split = tagged.groupBy("_file", "_block").agg(F.sum("_w").alias("_n"))
    file_w = before(Window.partitionBy("_file").orderBy("_block"))
    per_file = (per_split.groupBy("_file").agg(F.sum("_n").alias("_all"))
                         .select("_file", F.coalesce(F.sum("_all").over(before(Window.orderBy("_file"))), F.lit(0)).alias("_files")))
    offsets = per_split.withColumn("_off", F.coalesce(F.sum("_n").over(file_w), F.lit(0))).drop("_n").join(per_file, "_file")
    out = inside.join(offsets, ["_file", "_block"])
    return (out.withColumn(name, F.col("_files") + F.col("_off") + F.col("_in") + F.lit(start))
               .drop("_files", "_off", "_in", "_w", "_mid", "_block", "_file"))


def _number(tagged: DataFrame, split_key, name: str, start: int) -> DataFrame:
    """Offset of the row's split plus its place inside it."""
    with_key = tagged.withColumn("_k", split_key)
    per_split = with_key.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_split.select("_k", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = with_key.join(offsets, "_k")
    return out.withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first") + F.lit(start)).drop("_k", "_off", "_first", "_mid")
