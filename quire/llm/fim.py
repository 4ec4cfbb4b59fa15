"""Fill-in-the-middle transformation as a pipeline of Arrow kernels.

A batch of texts is split into units (code points) held as one list array. The
lists are flattened with their parent indices; a unit's ordinal is its place
behind its parent's first unit; comparing ordinals with the two cuts of the
parent gives every unit a role (prefix, middle, suffix). Units are filtered by
role, the lists rebuilt, the pieces joined per list, and the pieces joined with
the markers in the order of the document's form.

Texts over ``FRAGMENT`` bytes are cut into fragments at unit bounds; a fragment
is a list of its own whose ordinals go on where the one before ended, and a
second join puts the fragments' pieces together, so a task holds the unit
arrays of one fragment at a time besides the texts themselves.

Defined results: a null text is empty and, like every text that is empty or
holds a marker, has the form ``plain``; a null ``doc_id`` hashes as no digits;
repeated rows are transformed alike; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.textbytes import chunks

# Fixed values of the transformation: its markers, and the shares of its forms in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = "1"
FRAGMENT = 4 << 20
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers of a document: the first four groups of eight digits of the
    hex SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def unit_lists(data: np.ndarray, bounds: np.ndarray) -> pa.LargeListArray:
    """The code points of the byte spans ``bounds[i]:bounds[i + 1]`` as lists of
    strings, over the same bytes."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data))
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(starts, bounds), pa.int64()), units)


def _fragments(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Bounds of the fragments of all texts: text bounds, and cuts at unit
    bounds within texts over ``FRAGMENT`` bytes."""
    cuts = [offs]
    for i in np.flatnonzero(np.diff(offs) > FRAGMENT).tolist():
        at = np.arange(offs[i] + FRAGMENT, offs[i + 1], FRAGMENT)
        for _ in range(3):                     # a unit has four bytes at most
            at = np.where((data[at] & 0xC0) == 0x80, at - 1, at)
        cuts.append(at)
    return np.sort(np.concatenate(cuts))


def _role_pieces(lists: pa.LargeListArray, before: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix piece of every list, whose ordinals begin at
    ``before`` and are cut at ``first`` and ``second``."""
    flat = pc.list_flatten(lists)
    parents = pc.list_parent_indices(lists)
    begin = pa.array(np.asarray(lists.offsets)[:-1] - before, pa.int64())
    ordinals = pc.subtract(pa.array(np.arange(len(flat)), pa.int64()), pc.take(begin, parents))
    in_prefix = pc.less(ordinals, pc.take(pa.array(first, pa.int64()), parents))
    in_suffix = pc.greater_equal(ordinals, pc.take(pa.array(second, pa.int64()), parents))
    pieces = []
    for role in (in_prefix, pc.and_not(pc.invert(in_prefix), in_suffix), in_suffix):
        sizes = np.bincount(pc.filter(parents, role).to_numpy(), minlength=len(lists))
        rebuilt = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int64()), pc.filter(flat, role))
        pieces.append(pc.binary_join(rebuilt, pa.scalar("", pa.large_string())))
    return pieces


def transform_batch(rows: pa.RecordBatch, data: np.ndarray, offs: np.ndarray) -> pa.RecordBatch:
    """One batch: ``rows`` has ``doc_id`` and the draws ``h1..h4``."""
    data = np.ascontiguousarray(data)
    raw = data.tobytes()
    whole = pa.LargeStringArray.from_buffers(len(offs) - 1, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(raw))
    n = pc.utf8_length(whole).to_numpy()
    h1, h2, h3, h4 = [rows.column(rows.schema.get_field_index(f"h{i}")).to_numpy() for i in range(1, 5)]
    a, b = h1 % (n + 1), h2 % (n + 1)
    first, second = np.minimum(a, b), np.maximum(a, b)
    marked = pc.match_substring_regex(whole, f"{PREFIX}|{SUFFIX}|{MIDDLE}").to_numpy(zero_copy_only=False)
    plain = (n == 0) | marked | (h3 % 100 >= TRANSFORMED)
    spm = ~plain & (h4 % 100 < SUFFIX_FIRST)
    bounds = _fragments(data, offs)
    text = np.searchsorted(offs, bounds[:-1], side="right") - 1        # of every fragment; empty texts have none
    text = np.minimum(text, len(offs) - 2)
    lists_at, parts = 0, [[], [], []]
    sizes = np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), np.minimum(bounds[:-1], max(len(data) - 1, 0))) if len(data) else np.zeros(len(text), np.int64)
    sizes = np.where(np.diff(bounds) > 0, sizes, 0)
    running = np.cumsum(sizes) - sizes
    before_of = running - (np.append(0, np.cumsum(n)))[text]
    while lists_at < len(text):                # fragments of one step: FRAGMENT bytes of units at most
        to = int(np.searchsorted(bounds, bounds[lists_at] + FRAGMENT, side="right")) - 1
        to = min(max(to, lists_at + 1), len(text))
        lo = bounds[lists_at]
        lists = unit_lists(data[lo:bounds[to]], bounds[lists_at:to + 1] - lo)
        here = slice(lists_at, to)
        for got, piece in zip(parts, _role_pieces(lists, before_of[here], first[text[here]], second[text[here]])):
            got.append(piece)
        lists_at = to
    per_text = pa.array(np.searchsorted(text, np.arange(len(offs))), pa.int64())
    empty = pa.scalar("", pa.large_string())
    prefix, middle, suffix = [pc.binary_join(pa.LargeListArray.from_arrays(per_text, pa.concat_arrays(p) if p else pa.array([], pa.large_string())), empty)
                              for p in parts]
    mark = [pa.scalar(m, pa.large_string()) for m in (PREFIX, SUFFIX, MIDDLE)]
    psm_out = pc.binary_join_element_wise(mark[0], prefix, mark[1], suffix, mark[2], middle, empty)
    spm_out = pc.binary_join_element_wise(mark[1], suffix, mark[0], prefix, mark[2], middle, empty)
    is_plain, is_spm = pa.array(plain), pa.array(spm)
    output = pc.if_else(is_plain, whole, pc.if_else(is_spm, spm_out, psm_out))
    form = pc.if_else(is_plain, "plain", pc.if_else(is_spm, "spm", "psm"))
    doc_id = rows.column(rows.schema.get_field_index("doc_id"))
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(n.astype(np.int64)), form, pa.array(first.astype(np.int64), mask=plain), pa.array((second - first).astype(np.int64), mask=plain),
         output.cast(pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of
    ``docs`` (``doc_id, text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in chunks(batches):
            yield transform_batch(rows, data, offs)

    doc_id = F.col("doc_id").cast("long")
    drawn = [h.alias(f"h{i}") for i, h in enumerate(draws(doc_id, seed), 1)]
    return docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"), *drawn).mapInArrow(run, OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. A transformed text holds no marker,
    so the markers split the output into its pieces in their order."""
    pieces = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    piece = lambda i: F.get(pieces, F.lit(i))
    return F.when(form == "psm", F.concat(piece(1), piece(3), piece(2))) \
            .when(form == "spm", F.concat(piece(2), piece(3), piece(1))).otherwise(output)
