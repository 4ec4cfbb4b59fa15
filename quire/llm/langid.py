"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Training counts (language, bucket) on a bounded sample of labelled rows:
at most about ``TRAIN_PER_LANGUAGE`` per language, drawn by a hash of the row.
The log-probability matrix has languages x ``BUCKETS`` entries, a fixed size
for a checked number of languages, and is broadcast; batches are scored in
numpy over their non-zero n-grams.

A prediction sees the text alone. Defined results: ``und`` with score 0 if the
text is null or has no letter; without any training row every text is
``und``; equal texts get equal results; null or repeated ids keep their rows;
extra columns are passed by; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.textbytes import chunks

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
ALPHA = 0.5                    # added to every count
TRAIN_PER_LANGUAGE = 4000      # bound of the training sample
MOST_LANGUAGES = 512           # of one broadcast matrix (512 x 65,536 floats); more are compared page by page
SHARPNESS = 20.0               # of the score, per n-gram
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter of all planes, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for i in range(len(table)):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _characters(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters (0 for all else) of a byte buffer of texts, and the
    texts' offsets in characters."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    out = _letters()[points]
    return out, np.minimum(begins[offs], len(out))


def _ngrams(chars: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each character."""
    acc = np.full(len(chars) - order + 1, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for j in range(order):
        acc = (acc ^ chars[j:len(chars) - order + 1 + j]) * np.uint32(0x85EBCA6B)
        acc ^= acc >> np.uint32(15)
    return (acc * np.uint32(0xC2B2AE35) >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int32)


def _features(data: np.ndarray, offs: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the buckets of all n-grams with a letter, and the index
    of each text's first one (texts + 1 entries)."""
    chars, at = _characters(data, offs)
    for order in ORDERS:
        if len(chars) < order:
            continue
        grams = _ngrams(chars, order, buckets)
        # inside one text and with a letter at the first or last place
        inside = np.zeros(len(chars) + 1, bool)
        inside[:len(grams)] = (chars[:len(grams)] != 0) | (chars[order - 1:] != 0)
        for back in range(1, order):
            cut = at[1:-1] - back
            inside[cut[cut >= 0]] = False
        keep = np.flatnonzero(inside[:len(grams)])
        yield grams[keep], np.searchsorted(keep, at)


def training_counts(rows: DataFrame, languages: list[str], buckets: int = BUCKETS) -> np.ndarray:
    """Counts (language, bucket) over ``rows`` (``text, lang``), summed by Spark;
    the driver receives at most languages x buckets numbers."""
    index = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(index), buckets), np.int64)
        for part, data, offs in chunks(batches):
            langs = np.array([index[x] for x in part.column("lang").to_pylist()])
            if not len(data):
                continue
            for grams, first in _features(data, offs, buckets):
                owner = np.repeat(langs, np.diff(first))
                counts += np.bincount(owner * buckets + grams, minlength=counts.size).reshape(counts.shape)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[lang, bucket])],
                                         names=["l", "b", "n"])

    got = rows.select("text", "lang").mapInArrow(run, "l int, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(index), buckets))
    counts[got["l"].to_numpy(np.int64), got["b"].to_numpy(np.int64)] = got["n"].to_numpy()
    return counts


def label_pages(rows: DataFrame) -> Iterator[dict[str, int]]:
    """The labels in ascending order with their numbers of rows, at most
    ``MOST_LANGUAGES`` at a time."""
    last = None
    while True:
        left = rows if last is None else rows.where(F.col("lang") > F.lit(last))
        page = left.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES).collect()
        if page:
            yield {r["lang"]: r["count"] for r in page}
        if len(page) < MOST_LANGUAGES:
            return
        last = page[-1]["lang"]


def train(rows: DataFrame, sizes: dict[str, int], per_language: int = TRAIN_PER_LANGUAGE) -> np.ndarray:
    """The log-probability matrix (bucket, language) of the labels in ``sizes``
    from a bounded sample of ``rows`` (``doc_id, text, lang``)."""
    span = 1 << 20
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(span, -(-span * per_language // n)))])
    sample = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(span)) < F.try_element_at(share, F.col("lang")))
    counts = training_counts(sample, list(sizes))
    logs = np.log((counts + ALPHA) / (counts.sum(1, keepdims=True) + ALPHA * counts.shape[1]))
    return np.ascontiguousarray(logs.T.astype(np.float32))


def compared(docs: DataFrame, languages: list[str], logs: np.ndarray, names: list[str], begun: bool) -> DataFrame:
    """``docs`` with four columns called ``names``: the best language so far, its
    log-likelihood per n-gram, the likelihoods' sum relative to it, and the number
    of n-grams. ``begun`` says that an earlier page has set them."""
    model = docs.sparkSession.sparkContext.broadcast((languages, logs))
    kept = docs.columns[:-4] if begun else docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, matrix = model.value
        for part, data, offs in chunks(batches):
            total, grams_of = np.zeros((part.num_rows, len(langs))), np.zeros(part.num_rows, np.int64)
            if len(data):
                for grams, first in _features(data, offs, len(matrix)):
                    some = np.flatnonzero(np.diff(first))
                    if len(some):
                        total[some] += np.add.reduceat(matrix[grams], first[:-1][some], axis=0, dtype=np.float64)
                        grams_of += np.diff(first)
            mean = total / np.maximum(grams_of, 1)[:, None]
            top = mean.max(1)
            summed = np.exp(SHARPNESS * (mean - top[:, None])).sum(1)
            pred = [langs[b] for b in mean.argmax(1).tolist()]
            if begun:
                old, old_top, old_sum = (part.column(len(kept) + i) for i in range(3))
                old_top, old_sum = old_top.to_numpy(), old_sum.to_numpy()
                pred = [b if new else a for a, b, new in zip(old.to_pylist(), pred, (top > old_top).tolist())]
                best = np.maximum(top, old_top)
                summed = summed * np.exp(SHARPNESS * (top - best)) + old_sum * np.exp(SHARPNESS * (old_top - best))
                top = best
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(kept))], pa.array(pred, pa.string()), pa.array(top), pa.array(summed),
                                              pa.array(grams_of)], names=[*kept, *names])

    types = (T.StringType(), T.DoubleType(), T.DoubleType(), T.LongType())
    fields = [f for f in docs.schema.fields if f.name in kept]
    return docs.mapInArrow(run, T.StructType([*fields, *[T.StructField(n, t) for n, t in zip(names, types)]]))


def predict(docs: DataFrame, learn: Column, added: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds ``lang_pred, score`` (or as ``added`` names them) to ``docs``, which
    has ``doc_id, text, lang`` and any other columns, from a model of the rows for
    which ``learn`` holds. ``score`` is the winner's share of the languages'
    likelihoods per n-gram; equal likelihoods go to the least label."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    names, out, begun = [f"_{added[0]}_{i}" for i in range(4)], docs, False
    for sizes in label_pages(rows):
        out, begun = compared(out, list(sizes), train(rows, sizes), names, begun), True
    if not begun:
        return docs.select("*", F.lit(UNDETERMINED).alias(added[0]), F.lit(0.0).alias(added[1]))
    known = F.col(names[3]) > 0
    return out.select(*docs.columns, F.when(known, F.col(names[0])).otherwise(UNDETERMINED).alias(added[0]),
                      F.when(known, 1 / F.col(names[2])).otherwise(0.0).alias(added[1]))


def identify(docs: DataFrame, learn: Column) -> DataFrame:
    """``doc_id, text, lang_pred, score`` of ``docs`` (``doc_id, text, lang`` and
    others) from a model trained on the rows where ``learn`` holds; ``lang`` is
    no input of a prediction."""
    return predict(docs.select("doc_id", "text", "lang"), learn).drop("lang")
