"""Near-duplicate embeddings by a pivot-permutation index.

Every unit vector is described by its nearest reference points (pivots), in
order. Inverted lists are kept for pairs of pivots, so two vectors meet in a
list exactly if they share two of their first pivots; a pair that shares more
is counted in the list of its two smallest shared pivots. Meeting vectors are
compared by cosine in double precision.

The pivots are a bounded sample of the vectors, spread apart; every vector is
indexed. Their number and that of the indexed first places grow with the largest
label (``index_size``): more pivots keep the lists short, more places keep the
recall, which is 0.92 or more for pairs just above the threshold, also where all
vectors lie in one cone. Lists are cut into blocks of bounded size and blocks
are compared pair by pair inside tasks, which return counts and stars, never
the pairs: a list with a third of all vectors becomes many small tasks.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing; vectors of
different length do not link; repeated rows are vectors of their own; a null
``vec_id`` is linked and counted but names no component; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.graph import components
from quire.llm.scratch import Scratch

PIVOTS = 192          # reference points of a small table, a sample of the vectors
APART = 0.9           # most cosine of two pivots
FIRST = 6             # pivots of a vector's description that are indexed
SMALL = 100_000       # vectors of a label up to which these hold
STEPS = 4             # most doublings of the pivots: they are broadcast
BLOCK = 128           # vectors of a list that meet another block in one task


def index_size(n: int) -> tuple[int, int]:
    """Pivots and indexed first places for a label of ``n`` vectors: twice the
    pivots and one place more for every fourfold table beyond ``SMALL``."""
    step = 0
    while n > SMALL << 2 * step and step < STEPS:
        step += 1
    return PIVOTS << step, FIRST + step


def usable(rows: DataFrame) -> DataFrame:
    """Rows whose label and vector can link."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad
                      & F.exists("embedding", lambda x: x != 0))


def _unit(column: pa.Array) -> np.ndarray:
    """Unit vectors (rows) of a list column whose lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)       # keeps squares finite
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def reference_points(rows: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Pivots per vector length: ``n`` unit vectors of a sample of ``8 n``, each
    with a cosine under ``APART`` to those before (a dense group would else
    give pivots whose order is chance)."""
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(8 * n).select("embedding").collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r[0]), []).append(r[0])
    out = {}
    for dim, vectors in by_dim.items():
        chosen: list[np.ndarray] = []
        for x in _unit(pa.array(vectors)):
            if len(chosen) < n and (not chosen or (np.array(chosen) @ x).max() < APART):
                chosen.append(x)
        out[dim] = np.array(chosen)
    return out


def _points(known: dict[int, np.ndarray], dim: int, places: int, n: int) -> np.ndarray:
    """The pivots for a length; ``n`` seeded random directions for a length with
    fewer than four times ``places`` sampled ones."""
    got = known.get(dim)
    if got is None or len(got) < 4 * places:
        got = np.random.default_rng(dim).standard_normal((n, dim))
        got /= np.sqrt((got * got).sum(axis=1, keepdims=True))
        known[dim] = got
    return got


def describe(rows: DataFrame, pivots: dict[int, np.ndarray], places: int, n: int) -> DataFrame:
    """``row, label, dim, first``: the ``places`` nearest pivots of each vector, in order."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(shared.value)
        for batch in batches:
            dims = np.diff(batch.column(2).offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                near = np.argsort(-(_unit(part.column(2)) @ _points(known, dim, places, n).T), axis=1, kind="stable")[:, :places]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.full(len(near), dim, np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, places, dtype=np.int32)), pa.array(near.ravel().astype(np.int32)))],
                    names=["row", "label", "dim", "first"])

    return rows.select("row", "label", "embedding").mapInArrow(run, "row long, label string, dim int, first array<int>")


def _lists(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal key values over sorted batches."""
    held: list[pa.RecordBatch] = []

    def key_of(batch, i):
        return tuple(batch.column(k)[i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            c = batch.column(k).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if held and a == 0 and key_of(held[-1], 0) != key_of(batch, 0):
                yield pa.Table.from_batches(held)
                held = []
            elif a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the links (i, j)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def list_links(members: DataFrame, cosine: float) -> DataFrame:
    """``row, n, peer`` from members ``label, dim, p, q, bi, bj, side, row, first,
    embedding``, sorted by list and pair of blocks: links of each vector found in
    that pair of blocks, and one vector of its component there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _lists(batches, ["label", "dim", "p", "q", "bi", "bj"]):
            if t.num_rows < 2:
                continue
            t = t.combine_chunks()
            rows, side = t["row"].to_numpy(), t["side"].to_numpy()
            x = _unit(t["embedding"].combine_chunks())
            first = t["first"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
            p, q = t["p"][0].as_py(), t["q"][0].as_py()
            if t["bi"][0].as_py() == t["bj"][0].as_py():
                i, j = np.nonzero(np.triu(x @ x.T >= cosine, 1))
            else:
                a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                i, j = np.nonzero(x[a] @ x[b].T >= cosine)
                i, j = a[i], b[j]
            if not len(i):
                continue
            # counted where p, q are the two smallest pivots that both have
            both = np.where((first[i][:, :, None] == first[j][:, None, :]).any(2), first[i], 1 << 30)
            both.sort(axis=1)
            own = (both[:, 0] == p) & (both[:, 1] == q)
            i, j = i[own], j[own]
            if not len(i):
                continue
            n = np.bincount(i, minlength=len(rows)) + np.bincount(j, minlength=len(rows))
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(rows[hit]), pa.array(n[hit]), pa.array(rows[_local_roots(len(rows), i, j)[hit]])],
                                             names=["row", "n", "peer"])

    return members.mapInArrow(run, "row long, n long, peer long")


def embedding_links(vectors: DataFrame, scratch: Scratch, cosine: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``
    (``vec_id, embedding, label``)."""
    rows = scratch.keep(vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"),
                                       F.col("embedding").cast("array<double>") if dict(vectors.dtypes)["embedding"] != "array<float>" else "embedding",
                                       F.col("label").cast("string")), "rows")
    good = usable(rows)
    largest = good.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    n, places = index_size(largest)
    described = scratch.keep(describe(good, reference_points(good, n), places, n), "described")
    first = F.array_sort("first")
    pairs = F.array(*[F.struct(F.get(F.col("low"), F.lit(a)).alias("p"), F.get(F.col("low"), F.lit(b)).alias("q")) for a, b in combinations(range(places), 2)])
    posts = (described.withColumn("low", first).select("row", "label", "dim", "first", F.explode(pairs).alias("pq"))
                      .select("row", "label", "dim", "first", "pq.p", "pq.q"))
    key = ["label", "dim", "p", "q"]
    sizes = scratch.keep(posts.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "sizes")
    n_blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    posts = posts.join(sizes, key).withColumn("nb", n_blocks).withColumn("b", F.pmod(F.xxhash64("row"), F.col("nb")).cast("int"))
    posts = (posts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
                  .select("row", *key, "first", F.least("b", "other").alias("bi"), F.greatest("b", "other").alias("bj"),
                          (F.col("b") > F.col("other")).cast("int").alias("side")))
    members = posts.join(good.select("row", "embedding"), "row")
    dealt = members.repartition(*key, "bi", "bj").sortWithinPartitions(*key, "bi", "bj")
    found = scratch.keep(list_links(dealt, cosine), "found")
    counts = found.groupBy("row").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("row").alias("a"), F.col("peer").alias("b")), scratch)
    named = rows.select("row", "vec_id").join(roots.withColumnRenamed("id", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    named = scratch.keep(named, "named")
    smallest = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return (named.join(smallest, "root").join(counts, "row", "left")
                 .select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"),
                         F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"),
                         F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")))
