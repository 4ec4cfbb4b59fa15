"""Scoring texts with a weighted backoff automaton of order 3.

Model: every n-gram of the training texts is kept. A history of one or two
tokens that training has seen is a state; its arcs are the tokens that followed
it, weighted (c + prior * p') / (total + prior), where p' is the token's
probability one order below; every other token leaves over the failure arc,
weighted prior / (total + prior), to the state of the history's last token, and
from there to the root, where words have additive smoothing. The prior mass makes
the probabilities of a state sum to 1 over the known tokens and one unknown. A
text is traversed once from left to right: the state after a token is the
longest known suffix, failure arcs are followed until an arc fits, and log10
probabilities add up.

At scale: a text task makes blocks of some megabytes of text as word ids with
the block's vocabulary. The n-grams of a block are sorted distinct 56-bit
hashes per order; they travel as packed differences, one row per (block, order,
range of hashes), with their counts in the training texts. A task per range adds
the counts up over all blocks and answers every row with the totals in the
row's order, so questions are never written out and no n-gram is a row. Blocks
and answers meet by block; the model as a whole is never in one place and
nothing of it is broadcast.

Defined results: a null text is empty and has the end token alone; a null
``doc_id`` is scored, not learned from, and not held out; repeated rows count
as often as they occur; a text of any length is one piece of one block; extra
columns are ignored; an empty table gives an empty result. ``docs`` is read
twice and must give the same rows in the same partitions (a scan of files does,
also when executors are lost); answers that do not fit a block are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.scratch import Scratch
from quire.llm.textbytes import U64, chunks, mix, mix_int, span_hashes, word_bounds

ORDER = 3
PRIOR = (0.0, 4.0, 4.0)                   # mass that a state leaves to the order below, by order of its arcs
BLOCK_BYTES = 8 << 20
RANGE_KEYS = 1 << 21                      # questions that a counting task holds, about
KEY_BITS = 56
BEGIN, END = mix_int(1), mix_int(2)       # before the first token, as a token
BLOCK = ("block long, doc_id array<long>, held_out array<boolean>, n_words array<int>, vocabulary array<long>, ids binary")
ASKED = "block long, part int, keys binary, counts binary"
ANSWERED = "block long, part int, totals binary, known long, sum long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def packed(numbers: np.ndarray) -> bytes:
    """Non-negative integers as a width byte and that many bytes of each."""
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    return bytes([width]) + np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """Number, rows, words of each text, vocabulary and word ids of every block of
    a task's texts (``doc_id, held_out, learn, text``)."""
    base, number = TaskContext.get().partitionId() << 24, 0
    rows, hashes, sizes, size = [], [], [], 0

    def block():
        vocabulary, ids = np.unique(np.concatenate(hashes), return_inverse=True)
        return base + number, pa.Table.from_batches(rows).combine_chunks(), np.concatenate(sizes), vocabulary, ids

    for part, data, offs in chunks(batches):
        starts, ends, first = word_bounds(data, offs)
        rows.append(part.select(["doc_id", "held_out", "learn"]))
        hashes.append(span_hashes(data, starts, ends))
        sizes.append(np.diff(first))
        size += len(data)
        if size >= BLOCK_BYTES:
            yield block()
            number, rows, hashes, sizes, size = number + 1, [], [], [], 0
    if rows:
        yield block()


def word_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of texts as word ids: ``docs`` has ``doc_id, held_out, learn, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = lambda a, t: pa.array([a], pa.list_(t))
        for number, rows, n, vocabulary, ids in text_blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), one(rows["doc_id"].to_pylist(), pa.int64()), one(rows["held_out"].to_pylist(), pa.bool_()),
                 one(n.astype(np.int32), pa.int32()), one(vocabulary.view(np.int64), pa.int64()), pa.array([packed(ids)], pa.binary())],
                names=["block", "doc_id", "held_out", "n_words", "vocabulary", "ids"])

    return docs.select("doc_id", "held_out", "learn", F.col("text").cast("string")).mapInArrow(run, BLOCK)


def token_keys(ids: np.ndarray, n_words: np.ndarray, vocabulary: np.ndarray) -> Iterator[np.ndarray]:
    """Order by order, the key of the n-gram that ends in each token (words and, per
    text, one end) of a block; before a text stands BEGIN. A text's first token
    has no n-gram of order 3 and is given one that no n-gram shares."""
    last = np.cumsum(n_words + 1) - 1
    first = last - n_words
    token = np.empty(int((n_words + 1).sum()), U64)
    is_word = np.ones(len(token), bool)
    is_word[last] = False
    token[is_word] = vocabulary.view(U64)[ids]
    token[last] = U64(END)
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[first] = U64(BEGIN)
    yield mix(token) >> U64(64 - KEY_BITS)
    yield mix(before * U64(0x9E3779B97F4A7C15) + token) >> U64(64 - KEY_BITS)
    earlier = np.empty_like(token)
    earlier[1:] = before[:-1]
    earlier[first] = U64(0)
    history = mix(earlier * U64(0xC2B2AE3D27D4EB4F) + before)
    del earlier, before
    yield mix(history * U64(0x9E3779B97F4A7C15) + mix(token + U64(3))) >> U64(64 - KEY_BITS)


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    out = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    return out.view("<u8").ravel()


def questions(docs: DataFrame, range_bits: int) -> DataFrame:
    """The sorted distinct keys of every block, by order and range (``part``),
    packed as differences, with their counts in texts to learn from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, n_words, vocabulary, ids in text_blocks(batches):
            learn = np.repeat(rows["learn"].to_numpy().astype(bool), n_words + 1)
            for order, keys in enumerate(token_keys(ids, n_words, vocabulary)):
                distinct, place = np.unique(keys, return_inverse=True)
                counts = np.bincount(place[learn], minlength=len(distinct))
                del keys, place
                cuts = np.searchsorted(distinct >> U64(KEY_BITS - range_bits), np.arange((1 << range_bits) + 1, dtype=U64)).tolist()
                some = [(r, a, b) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(some), pa.int64()), pa.array([(order << range_bits) + r for r, _, _ in some], pa.int32()),
                     pa.array([packed(np.diff(distinct[a:b], prepend=U64(0))) for _, a, b in some], pa.binary()),
                     pa.array([packed(counts[a:b]) for _, a, b in some], pa.binary())], names=["block", "part", "keys", "counts"])

    return docs.select("doc_id", "held_out", "learn", F.col("text").cast("string")).mapInArrow(run, ASKED)


def answers(asked: DataFrame) -> DataFrame:
    """``block, part, totals``: the summed counts of every row's keys in the row's
    order. The first row of a part also has how many keys training knows and the
    sum of their counts."""
    def run(rows: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpacked(k.as_py())) for k in rows["keys"]]
        ends = np.cumsum([len(k) for k in keys])
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, place, np.concatenate([unpacked(c.as_py()) for c in rows["counts"]]).astype(np.int64))
        replies = [packed(totals[p]) for p in np.split(place, ends[:-1])]
        once = lambda v: pa.array([v] + [0] * (len(replies) - 1), pa.int64())
        return pa.table({"block": rows["block"], "part": rows["part"], "totals": pa.array(replies, pa.binary()),
                         "known": once(int((totals > 0).sum())), "sum": once(int(totals.sum()))})

    return asked.groupBy("part").applyInArrow(run, ANSWERED)


def log_scores(counts: list[np.ndarray], n_words: np.ndarray, tokens: int, types: int, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """log10 probabilities of every token at the root, and in its state: arcs
    fitting the longest known suffix, or what the failure arcs leave."""
    first = np.cumsum(n_words + 1) - (n_words + 1)
    root = (counts[0] + 0.5) / (tokens + 0.5 * (types + 1))
    # how often training has been in the state of one token, and of two
    one = np.empty_like(counts[0])
    one[1:] = counts[0][:-1]
    one[first] = texts
    two = np.empty_like(counts[1])
    two[1:] = counts[1][:-1]
    two[first] = 0
    p = root
    for state, arc, prior in ((one, counts[1], PRIOR[1]), (two, counts[2], PRIOR[2])):
        p = np.where(state > 0, (np.where(state > 0, arc, 0) + prior * p) / (state + prior), p)
    return np.log10(root), np.log10(p)


def score_texts(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for every row of ``docs`` (``doc_id, held_out, learn, text``)."""
    size, texts = docs.agg(F.sum(F.octet_length("text")), F.count(F.when(F.col("learn"), 1))).first()
    # about one distinct n-gram per order in seven bytes of text
    range_bits = max(4, ((size or 0) // 7 // RANGE_KEYS).bit_length())
    replies = scratch.keep(answers(questions(docs, range_bits)), "answers")
    types, tokens = replies.where(F.shiftright("part", range_bits) == 0).agg(F.sum("known"), F.sum("sum")).first()
    tokens, types = tokens or 0, types or 0

    def traverse(_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise ValueError("answers for a block that is not there: the documents were read differently the second time")
        row = {name: left[name][0] for name in left.column_names}
        ids, vocabulary = unpacked(row["ids"].as_py()), np.asarray(row["vocabulary"].values)
        n_words = np.asarray(row["n_words"].values).astype(np.int64)
        parts = right["part"].to_numpy()
        counts = []
        for order, keys in enumerate(token_keys(ids, n_words, vocabulary)):
            distinct, place = np.unique(keys, return_inverse=True)
            del keys
            mine = [right["totals"][int(i)].as_py() for i in np.flatnonzero(parts >> range_bits == order)[np.argsort(parts[parts >> range_bits == order])]]
            totals = np.concatenate([unpacked(t) for t in mine]).astype(np.float64) if mine else np.zeros(0)
            if len(totals) != len(distinct):
                raise ValueError("answers do not fit the block: the documents were read differently the second time")
            counts.append(totals[place])
            del place, totals
        base, logs = log_scores(counts, n_words, tokens, types, texts)
        first = np.cumsum(n_words + 1) - (n_words + 1)
        return pa.table({"doc_id": pa.array(row["doc_id"].as_py(), pa.int64()), "held_out": pa.array(row["held_out"].as_py(), pa.bool_()),
                         "n_tokens": pa.array(n_words + 1), "n_known": pa.array(np.add.reduceat((counts[0] > 0).astype(np.int64), first)),
                         "base_score": pa.array(np.add.reduceat(base, first)), "score": pa.array(np.add.reduceat(logs, first))})

    reply = replies.select(F.col("block").alias("to"), "part", "totals")
    scored = word_blocks(docs).groupBy("block").cogroup(reply.groupBy("to")).applyInArrow(traverse, SCORES)
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))
