"""Vectorised words, hashes and shingles over Arrow string columns.

The helpers run inside Spark's Arrow tasks. A batch of texts is one byte
buffer; words are found with table lookups on it and hashed with prefix sums
of a polynomial in an odd base modulo 2**64, so no Python loop touches a
character. Hashes are 64 bits; whole-set comparisons on them are treated as
exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32                       # A-Z only
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
CHUNK_BYTES = 4 << 20

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, dtype=U64)
        steps[0] = 1
        got = _powers[base] = np.multiply.accumulate(steps)
    return got


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64's constants)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def mix_int(x: int) -> int:
    with np.errstate(over="ignore"):
        return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], dtype=U64))[0])


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``(rows, bytes, offsets)`` pieces of the batches with at most ``limit``
    bytes of text each (a longer text makes a piece of its own). Null texts
    are empty."""
    for batch in batches:
        i = batch.schema.get_field_index(text)
        col = batch.column(i).cast(pa.large_binary()).fill_null(b"")
        offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
        values = col.buffers()[2]
        data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
        at, n = 0, len(col)
        while at < n:
            to = int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), n)
            yield batch.slice(at, to - at), data[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
            at = to


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word and, per text, its first word's index
    (``len(offs)`` entries: the last is the number of words)."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    word = ~SPACE[data]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    inner = offs[:-1][offs[:-1] < len(data)]
    before[inner] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    last = offs[1:][offs[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """One 64-bit hash per byte span, equal for equal (A-Z lower-cased) bytes."""
    if not len(starts):
        return np.zeros(0, U64)
    n = len(data)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(((LOWER[data] if lower else data).astype(U64) + U64(1)) * _power_table(BASE, n)[:n], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _power_table(BASE_INV, n + 1)[starts]
    return mix(raw + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """Per text: the sorted distinct hashes of its ``k``-word shingles; the
    whole sequence as one shingle with fewer words; empty without words."""
    n = len(words)
    if n >= k:
        acc = np.zeros(n - k + 1, dtype=U64)
        for j in range(k):
            acc += words[j:n - k + 1 + j] * U64(mix_int(j + 1) | 1)
        acc = mix(acc)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(acc[a:b - k + 1]))
        elif b > a:
            whole = sum(int(w) * (mix_int(j + 1) | 1) for j, w in enumerate(words[a:b].tolist()))
            out.append(np.array([mix_int(whole + (b - a) * 0x2545F4914F6CDD1D)], dtype=U64))
        else:
            out.append(np.zeros(0, U64))
    return out


def list_column(arrays: list[np.ndarray], dtype=np.int64, pa_type=pa.int64()) -> pa.ListArray:
    """A list column from one numpy array per row (64-bit hashes as signed)."""
    offs = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offs[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat.view(dtype) if flat.dtype == U64 else flat.astype(dtype), pa_type))
