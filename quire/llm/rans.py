"""A static range asymmetric numeral system over token ids, in numpy.

One table of symbol frequencies (summing to a power of two) is shared by all
blocks. A block deals its ids over ``lanes`` interleaved coders: id i belongs
to lane i mod lanes, and one vector step codes an id of every lane. States are
64-bit, renormalised in 32-bit words, all lanes on one word stream that is read
in (step, lane) order. Every ``segment`` steps a checkpoint holds the lane
states, the place in the stream and the checksum of the segment's ids, so
segments decode independently of each other.

Layout of a block (little-endian): magic, version, bits of the table's total,
bytes of an id, lanes, steps of a segment, ids, words, checksum of the table,
checksum of all that follows the head; then per segment its first word, its
ids' CRC-32 and the lane states; then the words.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np

U64, U32 = np.uint64, np.uint32
MAGIC = b"QANS"
VERSION = 1
LOW = 1 << 31                 # states stay in [2**31, 2**63)
LANES = 2048
SEGMENT = 256                 # steps between checkpoints
LEAST_BITS = 20
HEAD = struct.Struct("<4sBBBxIIQQII")


@dataclass(frozen=True)
class Table:
    """Frequencies of the symbols 0, 1, ...; they sum to ``2**bits``."""

    freq: np.ndarray
    bits: int

    @classmethod
    def of_counts(cls, counts: np.ndarray, least_bits: int = LEAST_BITS) -> "Table":
        """Counts scaled to a power of two; a symbol that occurs keeps 1 at least."""
        counts = np.asarray(counts, dtype=np.float64)
        used = np.flatnonzero(counts > 0)
        bits = max(least_bits, int(len(used)).bit_length() + 1)
        freq = np.zeros(len(counts), np.int64)
        if len(used):
            freq[used] = np.maximum(1, np.floor(counts[used] / counts[used].sum() * (1 << bits))).astype(np.int64)
            order = used[np.argsort(-freq[used], kind="stable")]
            freq[order[0]] += max(0, (1 << bits) - int(freq.sum()))
            over = int(freq.sum()) - (1 << bits)
            while over > 0:                # what the rounding up to 1 took, from the large ones
                take = np.minimum(freq[order] // 2, -(-over * freq[order] // int(freq.sum())))
                take = np.minimum(take, np.maximum(0, over - (np.cumsum(take) - take)))
                freq[order] -= take
                over -= int(take.sum())
        return cls(freq, bits)

    @cached_property
    def start(self) -> np.ndarray:
        return (np.cumsum(self.freq) - self.freq).astype(U64)

    @cached_property
    def symbol(self) -> np.ndarray:
        """The symbol of every slot."""
        return np.repeat(np.arange(len(self.freq), dtype=U32), self.freq)

    @cached_property
    def check(self) -> int:
        return zlib.crc32(self.freq.astype("<i8").tobytes(), self.bits)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, segment: int = SEGMENT) -> bytes:
    """The block of ``ids`` (unsigned 16- or 32-bit)."""
    n = len(ids)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    if n and not table.freq[ids].all():
        raise ValueError("an id is not in the table")
    freq, start, bits = table.freq.astype(U64), table.start, U64(table.bits)
    x = np.full(lanes, LOW, U64)
    words: list[np.ndarray] = []
    states: list[np.ndarray] = []
    for step in range(steps - 1, -1, -1):
        s = ids[step * lanes:(step + 1) * lanes]
        f, y = freq[s], x[:len(s)]
        big = y >= f << U64(63 - table.bits)
        words.append(y[big].astype(U32))           # the low half
        y = np.where(big, y >> U64(32), y)
        q = y // f
        x[:len(s)] = (q << bits) + (y - q * f) + start[s]
        if step % segment == 0:
            states.append(x.copy())
    words.reverse()
    states.reverse()
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype("<u8")
    body = b"".join(
        [first[i * segment:i * segment + 1].tobytes() + struct.pack("<I", zlib.crc32(np.ascontiguousarray(ids[i * segment * lanes:(i + 1) * segment * lanes]).tobytes()))
         + state.astype("<u8").tobytes() for i, state in enumerate(states)] + [w.astype("<u4").tobytes() for w in words])
    return HEAD.pack(MAGIC, VERSION, table.bits, ids.dtype.itemsize, lanes, segment, n, int(first[-1]), table.check, zlib.crc32(body)) + body


@dataclass
class Block:
    """An encoded block, read segment by segment."""

    data: bytes
    table: Table

    def __post_init__(self):
        if len(self.data) < HEAD.size:
            raise ValueError("a block is cut short")
        magic, version, bits, width, self.lanes, self.segment, self.n, self.n_words, table_check, check = HEAD.unpack_from(self.data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a block of token ids")
        if bits != self.table.bits or table_check != self.table.check:
            raise ValueError("the block was encoded with another table")
        if zlib.crc32(memoryview(self.data)[HEAD.size:]) != check:
            raise ValueError("a block's checksum is wrong")
        self.dtype = np.dtype("<u2") if width == 2 else np.dtype("<u4")
        self.steps = -(-self.n // self.lanes)
        self.segments = -(-self.steps // self.segment)
        self._size = 12 + 8 * self.lanes
        self.words = np.frombuffer(self.data, "<u4", self.n_words, HEAD.size + self.segments * self._size)

    def decode_segment(self, i: int) -> np.ndarray:
        """The ids of segment ``i``, decoded from its checkpoint alone."""
        at = HEAD.size + i * self._size
        word, check = struct.unpack_from("<QI", self.data, at)
        x = np.frombuffer(self.data, "<u8", self.lanes, at + 12).astype(U64)
        freq, start, symbol = self.table.freq.astype(U64), self.table.start, self.table.symbol
        bits, mask = U64(self.table.bits), U64((1 << self.table.bits) - 1)
        lo, hi = i * self.segment, min((i + 1) * self.segment, self.steps)
        out = np.empty(min(hi * self.lanes, self.n) - lo * self.lanes, self.dtype)
        for step in range(lo, hi):
            begin = (step - lo) * self.lanes
            m = min(self.lanes, len(out) - begin)
            y = x[:m]
            slot = y & mask
            s = symbol[slot]
            out[begin:begin + m] = s
            y = freq[s] * (y >> bits) + slot - start[s]
            low = np.flatnonzero(y < U64(LOW))
            y[low] = (y[low] << U64(32)) | self.words[word:word + len(low)].astype(U64)
            word += len(low)
            x[:m] = y
        if zlib.crc32(out.tobytes()) != check:
            raise ValueError("a segment's checksum is wrong")
        if hi == self.steps and (word != self.n_words or (x != U64(LOW)).any()):
            raise ValueError("a block does not end in its first state")
        return out

    def decode(self) -> np.ndarray:
        parts = [self.decode_segment(i) for i in range(self.segments)]
        return np.concatenate(parts) if parts else np.zeros(0, self.dtype)
