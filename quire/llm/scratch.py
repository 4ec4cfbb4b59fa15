"""Written intermediate tables in the shared folder of the session.

A multi-step operator cuts its lineage by writing a step as Parquet under
``spark.checkpoint.dir`` and reading it back: a lost executor then costs a
re-read, and every executor sees the files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.operators.written import write_once
from quire.session import ensure_checkpoint_dir


class Scratch:
    """Tables of one operator run, each in a folder of its own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._paths: dict[int, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        out = write_once(df, path)
        self._paths[id(out)] = path
        return out

    def release(self) -> None:
        """Delete all tables of this run, once its result is written."""
        self._delete(self.root)
        self._paths.clear()

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step and no result reads."""
        for table in tables:
            path = self._paths.pop(id(table), None)
            if path:
                self._delete(path)
