"""Compressed intermediate tables in the shared folder of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from quire.session import ensure_checkpoint_dir

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_once(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read from there. Nothing reads the shuffle files
    behind a written table again, so Spark deletes them when the write ends, not
    when the driver next collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(FREED, None)
    conf.set(FREED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(FREED) if before is None else conf.set(FREED, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read from
    there: columns of repeated terms, ids and lengths take a few bytes a row,
    which a checkpoint's rows do not."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quire-{name}-{uuid.uuid4().hex}"
    return write_once(df, path)
