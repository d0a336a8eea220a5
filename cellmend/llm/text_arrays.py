"""Words and shingles of many texts at once, as NumPy arrays.

A batch of texts is handled as one run of UTF-8 bytes, so no Python object is
made per word. A word is a maximal run of bytes other than space and 0x09-0x0D;
these bytes never occur inside a multi-byte character. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
#: Texts are handled in runs of about so many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        known = np.full(max(n, 2 * RUN_BYTES) + 1, base, np.uint64)
        known[0] = 1
        known = _powers[base] = np.multiply.accumulate(known)
    return known[: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of symbols; it does not depend on the place."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(symbols)
    total = np.zeros(n + 1, np.uint64)
    np.multiply(symbols.astype(np.uint64) + np.uint64(1), powers(_BASE, n)[:n], out=total[1:])
    np.cumsum(total, out=total)
    spans = (total[ends] - total[starts]) * powers(_BASE_INVERSE, n)[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * _STEP)


@dataclass
class Words:
    """The words of a run of texts; ``rows`` are their rows in the batch."""
    rows: np.ndarray        # row of each text in the batch
    first: np.ndarray       # texts + 1: first word of each text
    hashes: np.ndarray      # one per word
    data: np.ndarray        # bytes of the run
    starts: np.ndarray      # byte span of each word
    ends: np.ndarray
    text_at: np.ndarray     # texts + 1: first byte of each text

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owners(self) -> np.ndarray:
        """Which text of the run each word belongs to."""
        return np.repeat(np.arange(len(self.rows)), self.counts)


def text_runs(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of about ``RUN_BYTES``; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    if not len(column):
        return
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + RUN_BYTES, "right")) - 1)
        end = min(end, len(column))
        yield np.arange(row, end), data[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end


def _spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the words of a run of texts."""
    space = _IS_SPACE[data]
    edge = np.ones(len(data) + 1, bool)  # a word may begin or end here
    np.not_equal(space[1:], space[:-1], out=edge[1:-1])
    edge[at] = True
    places = np.flatnonzero(edge)
    inner = places[:-1]
    real = ~space[inner] if len(data) else np.zeros(0, bool)
    return inner[real], places[1:][real]


def word_limits(column: pa.Array | pa.ChunkedArray):
    """(rows, first word of each text, ((bytes, text offsets), word starts)), run by run."""
    for rows, data, at in text_runs(column):
        starts, _ = _spans(data, at)
        yield rows, np.searchsorted(starts, at), ((data, at), starts)


def words_of(column: pa.Array | pa.ChunkedArray, lower: bool) -> Iterator[Words]:
    """The words of all texts, run by run."""
    for rows, data, at in text_runs(column):
        starts, ends = _spans(data, at)
        if lower:
            data = LOWER[data]
        yield Words(rows, np.searchsorted(starts, at), span_hashes(data, starts, ends),
                    data, starts, ends, at)


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n successive numbers (len - n + 1 of them)."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * _STEP + hashes[k:k + size]
    return mix(out)


def shingle_sets(words: Words, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of text after text, texts + 1 offsets).

    A text of fewer than n words has its whole sequence as its one shingle; a
    text without words has none.
    """
    counts = words.counts
    long = np.repeat(counts >= n, counts)
    at = np.arange(len(words.hashes))
    whole = long & (at + n <= np.repeat(words.first[1:], counts))
    tokens, owners = sequence_hashes(words.hashes, n)[at[whole]], words.owners[whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        own = [sequence_hashes(words.hashes[words.first[t]:words.first[t + 1]], counts[t])
               + np.uint64(counts[t]) for t in short]
        tokens = np.concatenate([tokens, *own])
        owners = np.concatenate([owners, short])
    order = np.lexsort((tokens, owners))
    tokens, owners = tokens[order], owners[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
    tokens, owners = tokens[fresh], owners[fresh]
    return tokens, np.searchsorted(owners, np.arange(len(words.rows) + 1))
