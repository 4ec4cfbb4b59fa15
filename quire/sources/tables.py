"""The Parquet tables of a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns each query reads; naming them lets the scan prune the rest.
COLUMNS = {
    "documents": ["doc_id", "text"],
    "benchmark": ["item_id", "text"],
    "conversations": ["conv_id", "turn", "role", "text"],
    "pages": ["page_id", "url", "html"],
    "labels": ["doc_id", "quality", "toxic"],
}


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cols = columns if columns is not None else COLUMNS.get(name)
    return df.select(*cols) if cols else df
