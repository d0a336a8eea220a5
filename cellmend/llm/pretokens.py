"""Token ids and counts of many texts through their pre-tokens.

A byte-pair tokenizer encodes each pre-token on its own, and most pre-tokens of
a corpus are frequent ones. Texts are therefore cut into pre-tokens as arrays,
each distinct pre-token is looked up by its hash, and only those that no table
holds go to the tokenizer itself. A text with a character outside the ranges
for which the cut is laid down here, or with a special string, goes to the
tokenizer whole. So the results are the tokenizer's own in every case.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex

from cellmend.llm.text_arrays import span_hashes, text_runs

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 1, 2, 3, 4, 9
#: Characters that are cut here: Latin up to U+017F and common punctuation.
_KNOWN = [*range(9, 14), *range(32, 127), *range(0xA0, 0x130), *range(0x131, 0x180), 0x2013, 0x2014,
          *range(0x2018, 0x201F), 0x2020, 0x2021, 0x2022, 0x2026, 0x20AC]
_LAST = max(_KNOWN) + 2


def _classes() -> tuple[np.ndarray, np.ndarray]:
    kind, lower = np.full(_LAST, UNKNOWN, np.uint8), np.arange(_LAST, dtype=np.uint32)
    for code in _KNOWN:
        char = chr(code)
        kind[code] = (LETTER if regex.match(r"\p{L}", char) else NUMBER if regex.match(r"\p{N}", char)
                      else SPACE if regex.match(r"\p{White_Space}", char) else OTHER)
        lower[code] = ord(char.lower()) if len(char.lower()) == 1 else code
    return kind, lower


_KIND, _LOWER = _classes()
#: The contractions of both patterns.
_SUFFIXES = ("s", "t", "m", "d", "re", "ve", "ll")


@dataclass
class Cut:
    """Pre-tokens of a run of texts; ``whole`` marks texts that were not cut."""
    rows: np.ndarray
    texts: dict[int, str]   # the texts that were not cut
    codes: np.ndarray       # characters, lower-cased if the pattern is
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray       # texts + 1: first pre-token of each text
    whole: np.ndarray

    def codes_text(self, start: int, end: int) -> str:
        return self.codes[start:end].astype("<u4").tobytes().decode("utf-32-le")


def cut_runs(column: pa.Array | pa.ChunkedArray, words: bool) -> Iterator[Cut]:
    """Cut all texts. ``words``: the pattern that drops white space, lower-cases
    and takes digits one by one; else the one that keeps a space before a word."""
    for rows, data, at in text_runs(column):
        original = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        at = heads[at]
        codes = original
        n = len(codes)
        small = np.minimum(codes, _LAST - 1)
        kind = _KIND[small]
        odd = kind == UNKNOWN
        odd[:-1] |= (codes[:-1] == ord("<")) & (codes[1:] == ord("|"))
        seen = np.concatenate([[0], np.cumsum(odd)])
        whole = seen[at[1:]] > seen[at[:-1]]
        if words:
            codes = np.where(odd, codes, _LOWER[small])
        begins = np.zeros(n + 1, bool)
        begins[at] = True
        first = begins.copy()  # a text begins here
        begins[1:n] |= kind[1:] != kind[:-1]
        quote = np.flatnonzero((codes == ord("'")) & begins[:n])
        if words:
            begins[:n] |= kind == NUMBER
        elif n:
            space = kind == SPACE
            last = np.zeros(n, bool)  # the last white space before something else in its text
            last[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
            begins[:n] |= last
            takes = np.flatnonzero(last & (codes == 32))
            begins[takes + 1] = False
            quote = quote[begins[quote]]
        if len(quote):
            end_of = at[np.searchsorted(at, quote, "right")]
            padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
            for suffix in _SUFFIXES:
                hit = quote + len(suffix) < end_of
                for k, char in enumerate(suffix):
                    hit &= padded[quote + 1 + k] == ord(char)
                begins[quote[hit] + 1] = False
                begins[quote[hit] + 1 + len(suffix)] = True
        places = np.flatnonzero(begins)
        starts, ends = places[:-1], places[1:]
        owner = np.searchsorted(at, starts, "right") - 1
        keep = ~whole[owner] if len(starts) else np.zeros(0, bool)
        if words and len(starts):
            keep &= kind[starts] != SPACE
        starts, ends = starts[keep], ends[keep]
        texts = {int(i): original[at[i]:at[i + 1]].astype("<u4").tobytes().decode("utf-32-le")
                 for i in np.flatnonzero(whole)}
        yield Cut(rows, texts, codes, starts, ends, np.searchsorted(starts, at), whole)


class Table:
    """Pre-token hashes in order, with their lengths and, if wanted, their ids."""

    def __init__(self, keys=None, lengths=None):
        self.keys = np.zeros(0, np.uint64) if keys is None else keys
        self.lengths = np.zeros(0, np.int64) if lengths is None else lengths.astype(np.int64)
        self.places = np.zeros(len(self.keys), np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return place, self.keys[place] == keys

    def add(self, keys: np.ndarray, encoded: list[list[int]]) -> None:
        """``keys`` are in order and new."""
        lengths = np.array([len(x) for x in encoded], np.int64)
        flat = np.fromiter((i for x in encoded for i in x), np.uint32, int(lengths.sum()))
        at = np.searchsorted(self.keys, keys)
        places = len(self.ids) + np.cumsum(lengths) - lengths
        self.keys = np.insert(self.keys, at, keys)
        self.lengths = np.insert(self.lengths, at, lengths)
        self.places = np.insert(self.places, at, places)
        self.ids = np.concatenate([self.ids, flat])


#: Pre-tokens that a worker keeps; beyond it starts anew. About 40 bytes each.
CACHE_ENTRIES = 1_000_000
_workers: dict[tuple, Encoder] = {}


class Encoder:
    """A tokenizer behind a broadcast table of lengths and a worker's own cache."""

    def __init__(self, path: str, words: bool, frequent: Table | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.frequent, self.cache = words, frequent or Table(), Table()

    @classmethod
    def of_worker(cls, path: str, words: bool, frequent: Table | None = None) -> Encoder:
        """The same encoder, cache and all, for every task of this worker."""
        key = (path, words)
        if key not in _workers:
            _workers[key] = cls(path, words, frequent)
        _workers[key].frequent = frequent or Table()
        return _workers[key]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, cut: Cut, keys: np.ndarray, at: np.ndarray) -> None:
        """Encode the pre-tokens of ``keys`` (in order) that the cache lacks."""
        new = ~self.cache.find(keys)[1]
        keys, at = keys[new], at[new]
        if len(keys):
            self.cache.add(keys, self._encode([cut.codes_text(cut.starts[i], cut.ends[i]) for i in at]))

    def lengths(self, column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, tokens of each text)."""
        for cut in cut_runs(column, self.words):
            keys, at, back = np.unique(span_hashes(cut.codes, cut.starts, cut.ends),
                                       return_index=True, return_inverse=True)
            place, known = self.frequent.find(keys)
            n = np.zeros(len(keys), np.int64)
            n[known] = self.frequent.lengths[place[known]]
            if not known.all():
                miss = ~known
                n[miss] = self._cached(cut, keys[miss], at[miss])
            total = np.concatenate([[0], np.cumsum(n[back])])
            found = total[cut.first[1:]] - total[cut.first[:-1]]
            for i, ids in self._whole(cut):
                found[i] = len(ids)
            yield cut.rows, found

    def _cached(self, cut: Cut, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        if len(self.cache.keys) + len(keys) > CACHE_ENTRIES:
            self.cache = Table()
        self._learn(cut, keys, at)
        return self.cache.lengths[self.cache.find(keys)[0]]

    def _whole(self, cut: Cut) -> list[tuple[int, list[int]]]:
        odd = np.flatnonzero(cut.whole)
        return list(zip(odd, self._encode([cut.texts[int(i)] for i in odd]))) if len(odd) else []

    def ids(self, column) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, ids of all texts, texts + 1 offsets)."""
        for cut in cut_runs(column, self.words):
            keys, at, back = np.unique(span_hashes(cut.codes, cut.starts, cut.ends),
                                       return_index=True, return_inverse=True)
            self._cached(cut, keys, at)
            place = self.cache.find(keys)[0]
            lengths, places = self.cache.lengths[place][back], self.cache.places[place][back]
            total = np.concatenate([[0], np.cumsum(lengths)])
            flat = (self.cache.ids[np.repeat(places - total[:-1], lengths) + np.arange(total[-1])]
                    if len(lengths) else np.zeros(0, np.uint32))
            limits = total[cut.first]
            whole = self._whole(cut)
            if whole:
                parts, last = [], 0
                counts = np.diff(limits)
                for i, own in whole:
                    parts += [flat[last:limits[i]], np.array(own, np.uint32)]
                    last, counts[i] = limits[i], len(own)
                flat = np.concatenate([*parts, flat[last:]])
                limits = np.concatenate([[0], np.cumsum(counts)])
            yield cut.rows, flat, limits
