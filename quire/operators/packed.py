"""Document frequencies beside postings, which move once, by term, as packed blocks.

A task orders blocks of its postings by term and gives one compressed Arrow block
per part of the terms: a term's words travel once per block, and numbers as
columns. A row per posting would take several times the space. A part holds
about ``PART_ROWS`` postings (one term's own postings stay together) and is
counted on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

BLOCK_ROWS = 1 << 20    # postings that a task holds at a time
PART_ROWS = 1 << 20     # postings of a part, about
OUT_ROWS = 1 << 16      # rows of a batch


def with_df(postings: DataFrame, keys: list[str], tf: str = "tf") -> DataFrame:
    """``postings`` with ``df``, the number of rows with ``tf`` > 0 that agree on
    ``keys``. Reads ``postings`` twice: it is counted first."""
    columns = postings.columns
    rest = [c for c in columns if c not in keys]
    parts = max(int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-postings.count() // PART_ROWS))
    block_rows, out_rows = BLOCK_ROWS, OUT_ROWS

    def ipc(table: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column("_h").to_numpy()
            part = (h.view(np.uint64) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((h, part))
            h, part = h[order], part[order]
            table = table.drop_columns(["_h"]).take(pa.array(order)).combine_chunks()
            begins = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            # equal hashes of different terms: every row is a run of its own there
            for k in keys:
                c = table.column(k)
                same = pc.fill_null(pc.equal(c.slice(1), c.slice(0, len(c) - 1)), False).to_numpy()
                begins = np.union1d(begins, np.flatnonzero(~same) + 1)
            runs = np.append(begins, len(h))
            terms = table.select(keys).take(pa.array(begins)).append_column("_rows", pa.array(np.diff(runs)))
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            ends = np.append(cuts[1:], len(part))
            spots = np.searchsorted(begins, cuts), np.searchsorted(begins, ends)
            return pa.RecordBatch.from_arrays(
                [pa.array(part[cuts].astype(np.int32)),
                 pa.array([ipc(terms.slice(a, b - a)) for a, b in zip(*(s.tolist() for s in spots))], pa.binary()),
                 pa.array([ipc(table.select(rest).slice(a, b - a)) for a, b in zip(cuts.tolist(), ends.tolist())], pa.binary())],
                names=["part", "terms", "rows"])

        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= block_rows:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    def counted(terms: list[bytes], rows: list[bytes]) -> Iterator[pa.RecordBatch]:
        terms = pa.concat_tables([pa.ipc.open_stream(t).read_all() for t in terms]).combine_chunks()
        rows = pa.concat_tables([pa.ipc.open_stream(r).read_all() for r in rows]).combine_chunks()
        term = np.zeros(terms.num_rows, np.int64)
        for k in keys:
            column = terms.column(k).combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            code = column.dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
            term = np.unique(term * (int(code.max()) + 1) + code, return_inverse=True)[1]
        run = np.repeat(np.arange(terms.num_rows), terms.column("_rows").to_numpy())
        has = pc.fill_null(pc.greater(rows.column(tf), 0), False).to_numpy()
        df = np.bincount(term[run], has, minlength=int(term.max()) + 1).astype(np.int64)[term]
        terms = terms.drop_columns(["_rows"])
        for a in range(0, len(run), out_rows):
            at = run[a:a + out_rows]
            piece = terms.take(pa.array(at)).combine_chunks()
            other = rows.slice(a, len(at)).combine_chunks()
            found = {**{c: piece.column(c) for c in keys}, **{c: other.column(c) for c in rest}, "df": pa.array(df[at])}
            yield from pa.table({c: found[c] for c in [*columns, "df"]}).to_batches()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, terms, rows = None, [], []
        for batch in batches:
            for part, t, r in zip(batch.column("part").to_pylist(), batch.column("terms").to_pylist(), batch.column("rows").to_pylist()):
                if part != at and terms:
                    yield from counted(terms, rows)
                    terms, rows = [], []
                at = part
                terms.append(t)
                rows.append(r)
        if terms:
            yield from counted(terms, rows)

    schema = StructType(list(postings.schema.fields)).add("df", LongType())
    moved = (postings.withColumn("_h", F.xxhash64(*keys)).mapInArrow(pack, "part int, terms binary, rows binary")
                     .repartition(parts, "part").sortWithinPartitions("part"))
    return moved.mapInArrow(unpack, schema)
