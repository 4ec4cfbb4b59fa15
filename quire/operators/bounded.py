"""Broadcasts of bounded size.

A side is broadcast only in slices whose size is measured: its rows are
counted and weighed, dealt by key over as many slices as the bound asks for,
and each slice is broadcast on its own. A plan holds ``MOST_HELD`` slices: Spark
builds all broadcasts of a plan at once, on the driver. What more slices give is
written, a group of slices after the other.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.written import written
from quire.session import max_broadcast_bytes

ROW_BYTES = 96        # of a broadcast row besides its strings
MOST_HELD = 2         # broadcast slices that a union of joins holds at a time
MOST_LOOKUPS = 8      # broadcast slices that a lookup holds at a time; beyond, rows move to the key


def weight(df: DataFrame, strings: list[str]) -> int:
    """Bytes that the rows of ``df`` take in a broadcast, about."""
    size = F.lit(ROW_BYTES).cast("long")
    for c in strings:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return int(df.agg(F.sum(size)).first()[0] or 0)


def n_slices(df: DataFrame, strings: list[str]) -> int:
    """Slices that ``df`` needs so that each stays within the broadcast bound."""
    return max(1, -(-weight(df, strings) // max_broadcast_bytes(df.sparkSession)))


def slices(df: DataFrame, keys: list[str], n: int) -> list[DataFrame]:
    """``df`` dealt by key over ``n`` slices, each marked for broadcast."""
    if n == 1:
        return [F.broadcast(df)]
    at = F.pmod(F.xxhash64(*keys), F.lit(n))
    return [F.broadcast(df.where(at == i)) for i in range(n)]


def in_turn(parts: Iterable[DataFrame], n: int, most: int) -> DataFrame:
    """The union of the ``n`` parts. Beyond ``most``, groups of so many are written one
    after the other, and the driver holds the broadcasts of one group."""
    done, group = [], []
    for part in parts:
        group.append(part)
        if n > most and len(group) == most:
            done, group = [*done, written(reduce(DataFrame.unionByName, group), "slices")], []
    if done and group:
        group = [written(reduce(DataFrame.unionByName, group), "slices")]
    return reduce(DataFrame.unionByName, [*done, *group])


def sliced_join(big: DataFrame, small: DataFrame, keys: list[str], n: int, how: str = "inner") -> DataFrame:
    """``big`` joined (inner or left_semi) with every broadcast slice of ``small``."""
    return in_turn((big.join(part, keys, how) for part in slices(small, keys, n)), n, MOST_HELD)


def lookup(big: DataFrame, small: DataFrame, key: str, value: str, strings: list[str]) -> DataFrame:
    """``big`` with the ``value`` that ``small`` (``key``, ``value``; each key once)
    has for its ``key``, null without one. Broadcast in slices, one after the
    other, so ``big`` does not move; a ``small`` of more than ``MOST_LOOKUPS``
    slices is joined by a shuffle."""
    small = small.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    n = n_slices(small, [c if c != key else "_key" for c in strings])
    if n > MOST_LOOKUPS:
        return big.join(small, F.col(key) == F.col("_key"), "left").drop("_key").withColumnRenamed("_value", value)
    out = big.withColumn(value, F.lit(None).cast(small.schema["_value"].dataType))
    for part in slices(small, ["_key"], n):
        out = out.join(part, F.col(key) == F.col("_key"), "left").withColumn(value, F.coalesce(value, "_value")).drop("_key", "_value")
    return out
