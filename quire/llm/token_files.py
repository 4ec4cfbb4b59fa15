"""Documents as files of token ids, coded by a static asymmetric numeral system.

Writing: documents are range-partitioned by ``doc_id``; a task tokenizes its
documents in order and cuts them into blocks of whole documents. The counts of
all ids make the one frequency table (a row per symbol), running totals of the
blocks give every block its place among all ids, and a second task per block
encodes it (``rans``). A block is decoded without any other; inside it,
checkpoints let segments be decoded independently.

The written folder holds ``table`` (symbol, freq, bits, id bytes) and
``blocks``: one row per block with its first position, its number of ids and
the block's bytes, which hold the documents' index (``doc_id``, null flag,
length, with a checksum) followed by the coded ids. Both are Parquet, so that
writing is committed by Spark and a task that is run again leaves one copy.

Defined results: a null text is empty and has the end id alone; null
``doc_id``s come first; rows of one ``doc_id`` stand side by side, ordered by
their texts' hash, and each has its own place; extra columns are ignored; an
empty table gives files without blocks. A text of any length stays whole
within one block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import spark_partition_id

from quire.llm.prefix import with_start
from quire.llm.rans import Block, Table, encode
from quire.llm.scratch import Scratch
from quire.llm.textbytes import chunks
from quire.llm.unitcoder import coder

END = 1
BLOCK_IDS = 1 << 21           # a block closes at so many ids
INDEX = struct.Struct("<QI")
RAW = "block int, n long, width int, doc_ids binary, nulls binary, lengths binary, ids binary"
DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
IDS = "doc_id long, start long, ids array<int>"


def raw_blocks(docs: DataFrame, tokenizer_path: str, end: int) -> DataFrame:
    """Blocks of ids in document order: ``part, block`` order them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding = coder(tokenizer_path)
        number = 0
        keys, nulls, lengths, ids, size = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            one = lambda parts, t: pa.array([np.concatenate(parts).astype(t).tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([size], pa.int64()), pa.array([coding.dtype.itemsize], pa.int32()),
                 one(keys, "<i8"), one(nulls, "u1"), one(lengths, "<i8"), one(ids, coding.dtype)],
                names=["block", "n", "width", "doc_ids", "nulls", "lengths", "ids"])

        for rows, data, offs in chunks(batches):
            flat, bounds = coding.ids(data, offs)
            n = np.diff(bounds)
            full = np.empty(len(flat) + len(n), coding.dtype)
            last = np.cumsum(n + 1) - 1
            inner = np.ones(len(full), bool)
            inner[last] = False
            full[last] = end
            full[inner] = flat
            doc = rows.column(rows.schema.get_field_index("doc_id"))
            keys.append(doc.fill_null(0).to_numpy(zero_copy_only=False))
            nulls.append(doc.is_null().to_numpy(zero_copy_only=False))
            lengths.append(n + 1)
            ids.append(full)
            size += len(full)
            if size >= BLOCK_IDS:
                yield block()
                number, keys, nulls, lengths, ids, size = number + 1, [], [], [], [], 0
        if ids:
            yield block()

    order = [F.col("doc_id").asc_nulls_first(), "h", "row"]
    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
                 .repartitionByRange(*order).sortWithinPartitions(*order))
    return dealt.select("doc_id", "text").mapInArrow(run, RAW).withColumn("part", spark_partition_id())


def id_counts(raw: DataFrame) -> DataFrame:
    """``symbol, c``: how often every id occurs, summed per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for width, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                n = np.bincount(np.frombuffer(ids.as_buffer(), f"<u{width}"), minlength=len(total))
                n[:len(total)] += total
                total = n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["symbol", "c"])

    return raw.select("width", "ids").mapInArrow(run, "symbol long, c long").groupBy("symbol").agg(F.sum("c").alias("c"))


def table_of(rows) -> Table:
    """The table of collected ``symbol, freq, bits`` rows; no more than the vocabulary has."""
    freq = np.zeros(max((r["symbol"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        freq[r["symbol"]] = r["freq"]
    return Table(freq, rows[0]["bits"] if rows else 0)


def _counted(counts: DataFrame) -> Table:
    rows = counts.collect()
    c = np.zeros(max((r["symbol"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        c[r["symbol"]] = r["c"]
    return Table.of_counts(c)


@lru_cache(maxsize=2)
def _table(freq: bytes, bits: int) -> Table:
    return Table(np.frombuffer(freq, "<i8"), bits)


def _with_index(doc_ids: bytes, nulls: bytes, lengths: bytes) -> bytes:
    index = doc_ids + nulls + lengths
    return INDEX.pack(len(nulls), zlib.crc32(index)) + index


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, scratch: Scratch, end: int = END) -> None:
    """Write every text's ids and ``end`` to the folder ``path``, which must not
    hold token files yet, in ascending ``doc_id`` order."""
    spark = docs.sparkSession
    raw = scratch.keep(raw_blocks(docs, tokenizer_path, end), "raw")
    table = _counted(id_counts(raw))
    used = np.flatnonzero(table.freq)
    rows = [(int(s), int(table.freq[s]), table.bits) for s in used]
    spark.createDataFrame(rows, "symbol int, freq int, bits int").coalesce(1).write.parquet(f"{path}/table")
    starts = scratch.keep(with_start(raw.select("part", "block", "n"), [], "part", ["block"], "n", "start").select("part", "block", "start"), "starts")
    freq, bits = table.freq.astype("<i8").tobytes(), table.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = _table(freq, bits)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
                ids = np.frombuffer(row["ids"].as_buffer(), f"<u{row['width'].as_py()}")
                data = _with_index(*[row[c].as_py() for c in ("doc_ids", "nulls", "lengths")]) + encode(ids, shared)
                yield pa.RecordBatch.from_arrays([pa.array([row["start"].as_py()], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary())],
                                                 names=["start", "n", "data"])

    # block starts are small rows of one per block; the blocks themselves move once, to join them
    placed = raw.join(starts, ["part", "block"])
    placed.select("start", "width", "doc_ids", "nulls", "lengths", "ids").mapInArrow(run, "start long, n long, data binary") \
          .write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    scratch.drop(raw, starts)


def _blocks(spark: SparkSession, path: str) -> tuple[DataFrame, bytes, int]:
    table = table_of(spark.read.parquet(f"{path}/table").collect())
    return spark.read.parquet(f"{path}/blocks"), table.freq.astype("<i8").tobytes(), table.bits


def _documents(data: bytes, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``doc_id``, null flag and length of a block's documents, and their ids."""
    n, check = INDEX.unpack_from(data)
    index = data[INDEX.size:INDEX.size + 17 * n]
    if zlib.crc32(index) != check:
        raise ValueError("a block's index has a wrong checksum")
    ids = Block(data[INDEX.size + 17 * n:], table).decode()
    lengths = np.frombuffer(index, "<i8", n, 9 * n)
    if lengths.sum() != len(ids):
        raise ValueError("a block's index does not fit its ids")
    return np.frombuffer(index, "<i8", n), np.frombuffer(index, "u1", n, 8 * n).astype(bool), lengths, ids


def _read(spark: SparkSession, path: str, schema: str, column) -> DataFrame:
    blocks, freq, bits = _blocks(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = _table(freq, bits)
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_id, null, lengths, ids = _documents(data.as_py(), shared)
                before = np.cumsum(lengths) - lengths
                names, arrays = column(ids, before, lengths)
                yield pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64(), mask=null), pa.array(start + before, pa.int64()), *arrays],
                                                 names=["doc_id", "start", *names])

    return blocks.select("start", "data").mapInArrow(run, schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in the files."""
    def lists(ids, before, lengths):
        return ["ids"], [pa.ListArray.from_arrays(pa.array(np.append(before, len(ids)), pa.int32()), pa.array(ids.astype(np.int32)))]

    return _read(spark, path, IDS, lists)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files: the
    CRC-32 covers its ids as little-endian unsigned 32-bit integers."""
    def digests(ids, before, lengths):
        wide = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(wide[4 * a:4 * (a + n)]) for a, n in zip(before.tolist(), lengths.tolist())]
        return ["n_tokens", "ids_crc32"], [pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]

    return _read(spark, path, DIGESTS, digests)
