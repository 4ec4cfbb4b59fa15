"""Best-fit packing of token pieces into sequences of a fixed length.

Method: bound-certified repacking. Pieces are dealt over partitions of
bounded size and each partition runs best-fit decreasing; a lower bound from
dual-feasible functions on its lengths certifies its bin count where the two
agree. Partitions that are not certified release their bins with gaps; the
released pieces are dealt anew over fewer partitions and packed again, as
long as that saves sequences.

Only piece lengths travel; a hot length or source changes nothing, since
pieces are dealt by a hash of their identity.

Defined results: null or empty texts are one piece holding only the end id;
repeated rows (same ``doc_id`` and text) and null ``doc_id``s are packed as
pieces of their own; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.scratch import Scratch

LENGTH = 2048
END = 0
GROUP_ITEMS = 20_000         # pieces a packing task holds
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
# Fixed value of the byte-level pre-tokenizer: its split pattern.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """``text -> uint32 ids`` of the byte-level BPE in ``path`` (a ``tokenizers``
    file). The vocabulary's ids are its merge ranks, so ``tiktoken`` gives the
    ids that ``tokenizers`` gives, 2.5 times as fast; a file of another kind
    is encoded by ``tokenizers`` itself."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
    ranks = [model["vocab"].get(m.replace(" ", "", 1), -1) for m in merges]
    if (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None and not model.get("ignore_merges") and ranks and ranks == sorted(set(ranks)) and ranks[0] == 256):
        import tiktoken

        chars = _byte_chars()
        by_bytes = {bytes(chars[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=by_bytes, special_tokens=special)
        return lambda text: fast.encode_to_numpy(text, allowed_special="all")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def token_pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Pieces of every text's ids plus ``end``: texts of up to ``length`` ids
    are one piece; longer ones are cut from the back, so only the first piece
    may be shorter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for batch in batches:
            out = []
            for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end)).astype("<u4")
                start, piece = 0, 0
                while start < len(ids):
                    size = (len(ids) - start) % length or length
                    out.append((doc, row, piece, start, size, zlib.crc32(ids[start:start + size].tobytes())))
                    start, piece = start + size, piece + 1
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string"))
                .mapInArrow(run, PIECES))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every item, and the number of bins. Items go, longest
    first, into the fullest bin that still holds them."""
    order = np.argsort(-lengths, kind="stable")
    bins, offs = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[tuple[int, int]] = []      # (room left, bin), sorted
    count = 0
    for i in order.tolist():
        size = int(lengths[i])
        at = bisect_left(open_bins, (size, -1))
        if at < len(open_bins):
            room, b = open_bins.pop(at)
        else:
            room, b = capacity, count
            count += 1
        bins[i], offs[i] = b, capacity - room
        if room > size:
            insort(open_bins, (room - size, b))
    return bins, offs, count


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins that dual-feasible functions prove necessary.

    f_t maps lengths over ``capacity - t`` to the capacity, under ``t`` to 0 and
    keeps the rest; u_k rounds ``(k + 1) * length / capacity`` down to k-ths
    where it is not whole. Each value over the capacity, summed, is a bound."""
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    for t in np.unique(np.concatenate([sizes[sizes <= capacity // 2], capacity - sizes[sizes > capacity // 2] + 1])).tolist():
        if 0 < t <= capacity // 2:
            value = np.where(sizes > capacity - t, capacity, np.where(sizes < t, 0, sizes))
            best = max(best, -(-int((value * counts).sum()) // capacity))
    for k in range(1, 21):
        whole = sizes * (k + 1) % capacity == 0
        value = np.where(whole, sizes * k, sizes * (k + 1) // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def _pack_groups(items: DataFrame, groups: int, salt: int, capacity: int) -> DataFrame:
    """Best-fit decreasing per group: ``row, piece, length, grp, bin, offset,
    gap`` (room left in the bin) and ``certified`` (the group's count equals
    its lower bound)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row", "piece"], ascending=[False, True, True])
        lengths = pdf["length"].to_numpy()
        bins, offs, count = best_fit_decreasing(lengths, capacity)
        full = np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)
        return pdf.assign(bin=bins, offset=offs, gap=capacity - full[bins], certified=count == lower_bound(lengths, capacity))

    dealt = items.select("row", "piece", "length", F.pmod(F.xxhash64(F.lit(salt), "row", "piece"), F.lit(groups)).alias("grp"))
    return dealt.groupBy("grp").applyInPandas(
        run, "row long, piece int, length long, grp long, bin long, offset long, gap long, certified boolean")


def pack(pieces: DataFrame, scratch: Scratch, capacity: int = LENGTH) -> DataFrame:
    """``row, piece, sequence_id, offset`` for every piece."""
    full = (pieces.where(F.col("length") >= capacity)
                  .select("row", "piece", (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
                          F.lit(0).cast("long").alias("offset")))
    todo = pieces.where(F.col("length") < capacity)
    done = [full]
    count, last, salt = todo.count(), None, 0
    while count:
        packed = scratch.keep(_pack_groups(todo, max(1, -(-count // GROUP_ITEMS)), salt, capacity), f"round{salt}")
        stats = packed.agg(F.count_distinct("grp", "bin").alias("bins"),
                           F.count_distinct(F.when(~F.col("certified") & (F.col("gap") > 0), F.struct("grp", "bin"))).alias("open"),
                           F.count_distinct("grp").alias("groups")).first()
        kept = packed
        again = stats["open"] > 0 and stats["groups"] > 1 and (last is None or stats["open"] < last)
        if again:
            kept = packed.where(F.col("certified") | (F.col("gap") == 0))
            todo = packed.where(~F.col("certified") & (F.col("gap") > 0)).select("row", "piece", "length")
            last, count = stats["open"], todo.count()
        else:
            count = 0
        number = F.lit(salt << 56) + F.shiftleft("grp", 24) + F.col("bin")     # a group has fewer than 2**24 pieces
        done.append(kept.select("row", "piece", number.alias("sequence_id"), "offset"))
        salt += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def packed_pieces(docs: DataFrame, tokenizer_path: str, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """Every piece of every document with its place: ``doc_id, piece, start,
    length, ids_crc32, sequence_id, offset``."""
    pieces = scratch.keep(token_pieces(docs, tokenizer_path, length), "pieces")
    return pieces.join(pack(pieces, scratch, length), ["row", "piece"]).drop("row")
