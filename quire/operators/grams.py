"""Word grams counted where the texts are read, in Arrow batches.

Spark lower-cases the texts and says which characters are word characters; a
task finds the words of a batch in its bytes, gives every distinct word a number
and counts a text's grams as sorted numbers. No gram is a row before it is
counted, and only words that are new to a piece of the batch are hashed as text.

Sums over postings that need a term's df and not its words (``summed_squares``)
read ``hashed`` grams: two longs, 128 bits of BLAKE2b per word, in place of the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import WORD_PATTERN

PIECE_BYTES = 1 << 21   # texts of a batch that are counted at a time; a longer text alone
MARKER_N = 0
SCHEMA = "n int, t1 string, t2 string, doc_id long, dl long, tf long"
HASHED_SCHEMA = "n int, a long, b long, doc_id long, dl long, tf long"
PARTITION_BYTES = 12 << 20  # of text whose grams of one order are counted in a partition

_word_bits: list[np.ndarray] = []


def word_characters(spark: SparkSession) -> np.ndarray:
    """One bit per code point: those that ``WORD_PATTERN`` takes, by Spark's own
    regular expressions. Asked once per process."""
    if not _word_bits:
        points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
        lines = [("\n".join(map(chr, points[i:i + 8192])),) for i in range(0, len(points), 8192)]
        taken = spark.createDataFrame(lines, "line string").select(F.array_join(F.regexp_extract_all("line", F.lit(WORD_PATTERN), F.lit(0)), "").alias("taken"))
        bits = np.zeros(0x110000, bool)
        for row in taken.collect():
            bits[[ord(c) for c in row["taken"]]] = True
        _word_bits.append(np.packbits(bits))
    return _word_bits[0]


def _wanted(keep: DataFrame) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of the terms, whether each is a unigram, and the bigrams as sorted numbers."""
    table = keep.where(F.col("n") > MARKER_N).select("n", "t1", "t2").toArrow()
    n = table.column("n").to_numpy()
    t1, t2 = (table.column(c).cast(pa.string()).combine_chunks() for c in ("t1", "t2"))
    names = pc.unique(pa.concat_arrays([t1, t2]))
    a, b = (pc.index_in(t, value_set=names).to_numpy(zero_copy_only=False).astype(np.int64) for t in (t1, t2))
    single = np.zeros(len(names), bool)
    single[a[n == 1]] = True
    return names, single, np.sort(a[n == 2] * len(names) + b[n == 2])


def word_postings(read: DataFrame, orders: tuple[int, ...] = (1, 2), keep: DataFrame | None = None, hashed: bool = False) -> DataFrame:
    """``n, t1, t2, doc_id, dl, tf``: the distinct word grams of every row of ``read``
    (``doc_id, text``) and one length marker per row. With ``keep`` (``n, t1, t2``,
    of broadcast size) only the grams of those terms; lengths count all words.
    ``hashed`` gives ``a, b`` in place of ``t1, t2``, and no markers."""
    spark, piece_bytes, marker_n = read.sparkSession, PIECE_BYTES, MARKER_N
    model = spark.sparkContext.broadcast((word_characters(spark), None if keep is None else _wanted(keep)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, wanted = model.value
        letters = np.unpackbits(bits).astype(bool)
        single_byte = np.zeros(256, bool)
        single_byte[:128] = letters[:128]
        # a unigram has zeros as its last word; the two places of a bigram count differently
        odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)

        def word_bytes(raw: np.ndarray) -> np.ndarray:
            """Whether a byte belongs to a word character."""
            padded = np.concatenate([raw, np.zeros(4, np.uint8)])
            inside = single_byte[padded]
            at = np.flatnonzero(raw >= 0xC0)
            if len(at):
                lead, b1, b2, b3 = (padded[at + i].astype(np.int64) & (0xFF if i == 0 else 0x3F) for i in range(4))
                size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
                point = np.select([size == 2, size == 3], [(lead & 0x1F) << 6 | b1, (lead & 0x0F) << 12 | b1 << 6 | b2],
                                  (lead & 0x07) << 18 | b1 << 12 | b2 << 6 | b3)
                taken = letters[np.minimum(point, 0x10FFFF)]
                for i in range(4):
                    inside[at[taken & (size > i)] + i] = True
            return inside[:len(raw)]

        def counted(raw: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, tuple[np.ndarray, ...]]:
            """Words, lengths of the texts ``raw[at[i]:at[i + 1]]``, and per gram its order, text, words and count."""
            inside = word_bytes(raw)
            cut = np.zeros(len(raw) + 1, bool)
            cut[at] = True
            begins = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate([[False], inside[:-1]])))
            ends = np.flatnonzero(inside & (cut[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
            offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
            words = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(raw[inside])).dictionary_encode()
            names, code = words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = np.diff(np.searchsorted(begins, at))
            owner = np.repeat(np.arange(len(lengths)), lengths)
            if wanted is not None:
                code = pc.index_in(names, value_set=wanted[0]).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
                names = wanted[0]
            size = len(names)
            texts = np.arange(len(lengths))
            blank = np.full(len(lengths), size)
            found = [(np.full(len(lengths), marker_n), texts, blank, blank, np.ones(len(lengths), np.int64))][hashed:]
            for n in orders if size else ():
                if n == 1:
                    key = owner * size + code
                    if wanted is not None:
                        key = key[(code >= 0) & wanted[1][code]]
                else:
                    near = owner[1:] == owner[:-1]
                    if wanted is not None:
                        near &= (code[1:] >= 0) & (code[:-1] >= 0)
                    key = (owner[:-1][near] * size + code[:-1][near]) * size + code[1:][near]
                    if wanted is not None:
                        pair = key % (size * size)
                        spot = np.searchsorted(wanted[2], pair)
                        key = key[np.append(wanted[2], -1)[spot] == pair]
                key, tf = np.unique(key, return_counts=True)
                key, last = (key, np.full(len(key), size)) if n == 1 else np.divmod(key, size)
                text, word = np.divmod(key, size)
                found.append((np.full(len(key), n), text, word, last, tf))
            return names, lengths, tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, np.int64),) * 5

        def hashes(names: pa.Array, n: np.ndarray, word: np.ndarray, last: np.ndarray) -> list[pa.Array]:
            digests = b"".join(blake2b(w, digest_size=16).digest() for w in names.cast(pa.binary()).to_pylist()) + bytes(16)
            halves = np.frombuffer(digests, np.uint64).reshape(-1, 2).T
            return [pa.array((h[word] * one + h[last] * two).view(np.int64)) for h, one, two in zip(halves, odd[:2], odd[2:])]

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.string())
            _, ends, data = texts.buffers()
            ends = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            a = 0
            while a < len(texts):
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + piece_bytes, side="right")) - 1)
                names, lengths, (n, text, word, last, tf) = counted(data[ends[a]:ends[b]], ends[a:b + 1] - ends[a])
                if hashed:
                    terms = hashes(names, n, word, last)
                else:
                    names = pa.concat_arrays([names, pa.array([""], pa.string())])
                    terms = [names.take(pa.array(word)), names.take(pa.array(last))]
                yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int32)), *terms, ids.take(pa.array(text + a)), pa.array(lengths[text].astype(np.int64)),
                                                  pa.array(tf.astype(np.int64))], names=columns)
                a = b

    schema = HASHED_SCHEMA if hashed else SCHEMA
    columns = [c.split()[0] for c in schema.split(", ")]
    return read.select("doc_id", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("text")).mapInArrow(run, schema)


def summed_squares(hashed: DataFrame, n_docs: int, truncated: bool, text_bytes: int) -> DataFrame:
    """``doc_id, n, sq``: squared tf-idf weights of hashed postings, summed. The
    postings move once, by term, to partitions of bounded size (a term's own
    postings apart), where df is counted."""
    spark = hashed.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes // PARTITION_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        table = pa.Table.from_batches(held).combine_chunks() if held else None
        if table is None or not table.num_rows:
            return
        a, b, n, tf = (table.column(c).to_numpy() for c in ("a", "b", "n", "tf"))
        order = np.argsort(a)
        x, y = a[order], b[order]
        if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():  # one half of the hash alone is equal
            order = np.lexsort((b, a))
            x, y = a[order], b[order]
        begins = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
        df = np.diff(np.append(begins, len(x)))
        share = n_docs // df if truncated else n_docs / df
        idf = np.log(np.maximum(share, 1e-300)) / np.log(2.0)
        idf[share <= 0] = 0.0
        weight = np.repeat(idf, df) * tf[order]
        doc = table.column("doc_id").combine_chunks()
        doc = doc.chunk(0) if isinstance(doc, pa.ChunkedArray) else doc
        known = doc.is_valid().to_numpy(zero_copy_only=False)[order]  # a posting without an id counts in df only
        doc, n, weight = doc.fill_null(0).to_numpy(zero_copy_only=False)[order][known], n[order][known], weight[known]
        for k in np.unique(n):
            ids, at = np.unique(doc[n == k], return_inverse=True)
            sums = np.bincount(at, weight[n == k] ** 2, minlength=len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), k, np.int32)), pa.array(sums)], names=["doc_id", "n", "sq"])

    moved = hashed.select("n", "a", "b", "doc_id", "tf").repartition(parts, "a", "b").mapInArrow(run, "doc_id long, n int, sq double")
    return moved.groupBy("doc_id", "n").agg(F.sum("sq").alias("sq"))
