"""Token ids of many texts from a ``tokenizers`` file, each distinct unit once.

A unit is a stretch of a text that the tokenizer encodes on its own: the file's
pre-tokenizer always cuts at ASCII blanks and between an ASCII letter or digit
and an ASCII mark (the apostrophe apart, which may begin a contraction), and
its normalizer looks at no character beyond such a cut. Units are found with
table lookups on the bytes of a batch and hashed to 64 bits; every unit that a
worker has not met is encoded by ``tokenizers``, and the ids are looked up for
all places where it stands. The table of met units is a cache of
``CACHE_UNITS`` entries at most (it is emptied when full) and never changes
an id. Texts that hold one of the file's special tokens, and files of another
kind, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from quire.llm.textbytes import LOWER, SPACE, U64, span_hashes

CACHE_UNITS = 1 << 20
TOGETHER = 200                 # plain words that are encoded as one string
# Fixed values of the word-level file: its pre-tokenizer's pattern and the mark that ends a word.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

LETTER, MARK, OTHER = 1, 2, 3
_KIND = np.full(256, OTHER, np.uint8)
_KIND[SPACE] = 0
for _c in range(0x21, 0x7F):
    _KIND[_c] = LETTER if chr(_c).isalnum() else MARK
_KIND[ord("'")] = OTHER


def unit_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every unit and, per text, its first unit's index."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    kind = _KIND[data]
    cut = np.empty(len(data) + 1, bool)
    cut[0] = cut[-1] = True
    # letter beside mark: 1 and 2; a blank on either side: a product of 0
    pair = kind[:-1] * kind[1:]
    cut[1:-1] = (pair == 0) | (pair == LETTER * MARK)
    cut[offs] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    some = kind[starts] != 0
    starts, ends = starts[some], ends[some]
    return starts, ends, np.searchsorted(starts, offs)


class UnitCoder:
    """``ids(data, offs)``: the ids of all texts of a batch."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_unit = (kinds == ["NFC", "Replace", "Lowercase"] and split.get("pattern") == {"Regex": PATTERN}
                        and spec["model"].get("end_of_word_suffix") == WORD_END)
        ends = [i for token, i in spec["model"]["vocab"].items() if token.endswith(WORD_END)]
        self.size = max(max(spec["model"]["vocab"].values()), *[t["id"] for t in spec.get("added_tokens", [])], 0) + 1
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.ends_word = np.zeros(self.size, bool)
        self.ends_word[ends] = True
        special = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(special).encode()) if special else None
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, U64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=self.dtype)

    def _encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in a row, and how many each has."""
        plain = np.array([u.isalpha() and u.isascii() for u in units], bool)
        counts = np.zeros(len(units), np.int64)
        words = [units[i].decode() for i in np.flatnonzero(plain)]
        lines = [" ".join(words[i:i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        word_ids = np.array([i for e in found for i in e.ids], dtype=self.dtype)
        last = np.flatnonzero(self.ends_word[word_ids])
        if len(last) != len(words):
            raise ValueError("a word of letters is not one pre-token")
        counts[plain] = np.diff(last, prepend=-1)
        others = [e.ids for e in self.tokenizer.encode_batch_fast([units[i].decode() for i in np.flatnonzero(~plain)], add_special_tokens=False)]
        counts[~plain] = [len(x) for x in others]
        out = np.empty(int(counts.sum()), self.dtype)
        from_word = np.repeat(plain, counts)
        out[from_word] = word_ids
        out[~from_word] = [i for x in others for i in x]
        return out, counts

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode the units of the (distinct, sorted) hashes that are not met yet."""
        if len(self.keys) + len(hashes) > CACHE_UNITS:
            self.clear()
        if len(self.keys):
            near = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            new = self.keys[near] != hashes
            hashes, starts, ends = hashes[new], starts[new], ends[new]
        if not len(hashes):
            return
        raw = LOWER[data].tobytes()
        ids, counts = self._encode_units([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
        at = len(self.flat) + np.cumsum(counts) - counts
        place = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, place, hashes)
        self.at = np.insert(self.at, place, at)
        self.n = np.insert(self.n, place, counts)
        self.flat = np.concatenate([self.flat, ids])

    def ids(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[offs[i]:offs[i + 1]]`` in a row, and the
        bounds of every text in them."""
        raw = data.tobytes()
        whole = np.zeros(len(offs) - 1, bool)
        if not self.by_unit:
            whole[:] = True
        elif self.special is not None:
            for hit in self.special.finditer(raw):
                whole[np.searchsorted(offs, hit.start(), side="right") - 1] = True
        if whole.any():
            parts = []
            for i, alone in enumerate(whole.tolist()):
                text = data[offs[i]:offs[i + 1]]
                parts.append(self._whole(text.tobytes()) if alone else self.ids(text, np.array([0, len(text)]))[0])
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        starts, ends, first = unit_bounds(data, offs)
        hashes = span_hashes(data, starts, ends)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        head = np.append(True, ranked[1:] != ranked[:-1])[:len(ranked)]
        distinct, example = ranked[head], order[head]
        self._learn(distinct, data, starts[example], ends[example])
        if not len(distinct):
            return np.zeros(0, self.dtype), np.zeros(len(offs), np.int64)
        slot = np.searchsorted(self.keys, distinct)
        which = np.empty(len(hashes), np.int64)
        which[order] = np.cumsum(head) - 1
        n = self.n[slot][which]
        stop = np.cumsum(n)
        place = np.repeat(self.at[slot][which] - (stop - n), n) + np.arange(int(stop[-1]))
        return self.flat[place], np.append(0, stop)[first]


@lru_cache(maxsize=2)
def coder(path: str) -> UnitCoder:
    return UnitCoder(path)
