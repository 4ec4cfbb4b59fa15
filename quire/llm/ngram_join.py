"""Exact Jaccard self-join of documents on word shingles.

Method: universe-partition pigeonhole. The hash universe is cut into units;
two sets that differ in at most H elements agree on a segment if the segments'
allowances (1 for an exactly equal segment, 2 for one equal up to one
deletion) sum to H + 1 or more. How many units a set size needs depends on its
size band. Per band a cost model allots exact segments and one-deletion
segments; of the exact segments a set indexes only the subset it needs (the
H + 1 it owes, largest segments first: small or empty ones are shared by
accident). Skipping is ordered by the segment's own content, so two sets that
agree on segments skip them alike and one agreeing segment always remains.

Sets of equal content are one class. Classes that share a bucket are linked
by exact verification (``bucketlinks``: pivots, then prefixes of differences),
which loses no component and never forms all pairs of a bucket.

Defined results: null or word-less texts have an empty set and no link (their
own component); a null ``doc_id`` keeps its row, takes part in no link and
has a null component; repeated rows get equal results; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.bucketlinks import bucket_links, shared_buckets
from quire.llm.graph import components
from quire.llm.scratch import Scratch
from quire.llm.textbytes import U64, chunks, list_column, mix, mix_int, shingles, span_hashes, word_bounds

BAND_GROWTH = 1.5           # sizes of a band: up to 1.5 times its smallest
EXPECTED_BAND = 1_000_000   # documents of a band the cost model expects
SPARE = 0.15                # units beyond those owed, so that accidental segments can be skipped
KEPT = 1.2                  # size of the segments indexed (the larger ones) over the mean
SHARED = 0.02               # share of a set's elements it expects unrelated sets to share
SIGNED = "row long, doc_id long, n_shingles long, set_a long, set_b long, keys array<long>"


@lru_cache(maxsize=None)
def band_starts(num: int, den: int, top: int) -> tuple[int, ...]:
    """Smallest size of each band, up to the first above ``top``. A set's
    partners lie in its own band or the next one above."""
    starts = [1]
    while starts[-1] <= top:
        starts.append(max(starts[-1] + 1, den * starts[-1] // num + 1, int(BAND_GROWTH * starts[-1])))
    return tuple(starts)


@lru_cache(maxsize=None)
def allocation(units: int, size: int) -> int:
    """Number of one-deletion segments (two units each) for a band with
    ``units`` units and sets of about ``size`` elements: the cheapest by rows
    indexed plus partners that agree on a segment by accident."""
    def cost(pairs: int) -> float:
        exact, each = units - 2 * pairs, size / units
        rows = exact + pairs * (1 + 2 * each)
        close = 2 * each * SHARED ** max(0.0, 2 * each - 1)
        return rows + EXPECTED_BAND * (exact * SHARED ** (KEPT * each) + pairs * close)

    return min(sorted({0, units // 2, *(2 ** i for i in range(units.bit_length()) if 2 ** i <= units // 2)}), key=cost)


def _keys(elems: np.ndarray, tagged: np.ndarray, band: int, units: int, pairs: int, owed: int) -> np.ndarray:
    """Bucket keys of one set (sorted hashes) under one band's partition."""
    exact = units - 2 * pairs
    unit = ((elems >> U64(32)) * U64(units)) >> U64(32)
    edges = np.concatenate([np.arange(exact), np.arange(exact, units + 1, 2)]) if pairs else np.arange(units + 1)
    at = np.searchsorted(unit, edges.astype(U64))
    at[-1] = len(elems)
    sums = np.zeros(len(elems) + 1, U64)
    np.cumsum(tagged, out=sums[1:])
    seg = sums[at[1:]] - sums[at[:-1]]
    salt = (np.arange(len(seg)) + (band << 32)).astype(U64) * U64(0xA24BAED4963EE407)
    whole = mix(seg ^ salt)
    sizes = at[1:] - at[:-1]
    spare = units - owed
    keep = np.ones(len(seg), bool)
    if spare > 0 and exact:
        order = np.lexsort((whole[:exact], sizes[:exact]))   # costliest first, by content
        keep[order[:spare]] = False
    out = [whole[keep]]
    if pairs:
        lo = int(at[exact])
        owner = np.repeat(np.arange(exact, len(seg)), sizes[exact:])
        out.append(mix((seg[owner] - tagged[lo:]) ^ salt[owner]))
    return np.concatenate(out)


def set_keys(elems: np.ndarray, num: int, den: int) -> np.ndarray:
    """All bucket keys of a set: in its own band, and in the next band if a
    partner there is possible."""
    n = len(elems)
    if n * (den - num) // num < 1:       # no different set is near enough
        return np.zeros(0, U64)
    starts = band_starts(num, den, den * n // num + 1)
    band = int(np.searchsorted(starts, n, side="right")) - 1
    tagged = mix(elems ^ U64(0x5851F42D4C957F2D))
    out = []
    for b in (band, band + 1):
        top = (starts[b + 1] if b + 1 < len(starts) else band_starts(num, den, starts[b])[b + 1]) - 1
        largest = min(den * n // num, top)
        if b > band and largest < starts[b]:
            continue
        units = 2 * top * (den - num) // (den + num) + 1
        units += int(units * SPARE) + 1
        owed = (n + largest) * (den - num) // (den + num) + 1
        out.append(_keys(elems, tagged, b, units, allocation(units, (starts[b] + top) // 2), owed))
    return np.unique(np.concatenate(out))


def _doc_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        for rows, data, offs in chunks(batches):
            starts, ends, first = word_bounds(data, offs)
            yield rows, shingles(span_hashes(data, starts, ends), first, k)
    return run


def sign(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Per document: set size, a 128-bit fingerprint of the set, bucket keys."""
    def run(batches):
        for rows, sets in _doc_sets(k)(batches):
            prints = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            ab = np.frombuffer(b"".join(prints), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(ab[:, 0]), pa.array(ab[:, 1]),
                 list_column([set_keys(s, num, den) for s in sets])], names=["row", "doc_id", "n_shingles", "set_a", "set_b", "keys"])
    row = F.col("row") if "row" in docs.columns else F.monotonically_increasing_id().alias("row")
    return docs.select(row, F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SIGNED)


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """``id, elems``: the sorted shingle hashes of each document."""
    def run(batches):
        for rows, sets in _doc_sets(k)(batches):
            yield pa.RecordBatch.from_arrays([rows.column("id"), list_column([np.sort(s.view(np.int64)) for s in sets])],
                                             names=["id", "elems"])
    return docs.mapInArrow(run, "id long, elems array<long>")


def ngram_components(docs: DataFrame, scratch: Scratch, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """``row, doc_id, n_shingles, component_id`` per row of ``docs`` (``doc_id,
    text``, and ``row`` if the caller has numbered its rows): components of the documents whose ``k``-word shingle sets have
    Jaccard >= num/den; ``component_id`` is the smallest ``doc_id``."""
    signed = scratch.keep(sign(docs, k, num, den), "signed")
    known = signed.where("doc_id is not null and n_shingles > 0")
    classes = known.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.min_by("keys", "doc_id").alias("keys"))
    classes = scratch.keep(classes, "classes")
    slim = scratch.keep(signed.select("row", "doc_id", "n_shingles", "set_a", "set_b"), "rows")
    scratch.drop(signed)
    signed, known = slim, slim.where("doc_id is not null and n_shingles > 0")
    rows = scratch.keep(shared_buckets(classes.select(F.explode("keys").alias("key"), F.col("rep").alias("id"))), "buckets")
    slim = scratch.keep(classes.select("set_a", "set_b", "rep"), "reps")
    scratch.drop(classes)
    classes = slim
    ids = scratch.keep(rows.select("id").distinct(), "ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    found = sets_of(texts.join(ids, "id", "left_semi"), k).where(F.size("elems") > 0)
    repeated = not known.groupBy("doc_id").count().where("count > 1").isEmpty()
    sets = scratch.keep(found.distinct() if repeated else found, "sets")
    links = scratch.keep(bucket_links(rows, sets, num, den, scratch), "all-links")
    scratch.drop(rows, ids, sets)
    roots = components(links, scratch)
    roots = scratch.keep(classes.select("set_a", "set_b", "rep").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
                         .select("set_a", "set_b", F.coalesce("root", "rep").alias("root")), "class-roots")
    return (signed.select("row", "doc_id", "n_shingles", "set_a", "set_b").join(roots, ["set_a", "set_b"], "left")
                  .select("row", "doc_id", "n_shingles",
                          F.when(F.col("doc_id").isNotNull(),
                                 F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id"))).alias("component_id")))
