"""The suffix tree in one piece, for texts that fit a test: what the dealt one has to give."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from cellmend.llm.suffix_tree_lm import (
    DEPTH, DISCOUNT, LEAST_COUNT, LEAST_GAIN, LEAST_RATIO, _counted, _frequent, _place, _word_counts)

_SHIFT = np.int64(1 << 21)


@dataclass
class Level:
    """Contexts of one length and the next words that they list.

    ``grams`` are the frequent (context, word) pairs of this level, in order;
    a gram's index is the context of the next level. ``kept`` and ``rest``
    (log10 of what is left to the suffix) are by context, ``listed`` and
    ``gain`` (log10 of the word's probability over the root's) by gram.
    """
    grams: np.ndarray
    counts: np.ndarray
    kept: np.ndarray
    rest: np.ndarray
    listed: np.ndarray
    gain: np.ndarray


@dataclass
class Tree:
    words: np.ndarray    # frequent words' hashes, in order
    counts: np.ndarray
    total: int           # N
    distinct: int        # V
    levels: list[Level]

    def log_root(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def contexts(self, word: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level: the context of each token (-1: none) and its gram (-1: none)."""
        out = []
        context = np.full(len(word), -1, np.int64)
        context[1:] = word[:-1]
        context[at[:-1][at[:-1] < len(word)]] = -1
        for level in self.levels:
            both = (context >= 0) & (word >= 0)
            gram = np.full(len(word), -1, np.int64)
            gram[both] = _place(level.grams, context[both] * _SHIFT + word[both])
            out.append((context, gram))
            longer = np.full(len(word), -1, np.int64)
            longer[1:] = gram[:-1]
            longer[at[:-1][at[:-1] < len(word)]] = -1
            context = longer
        return out

    def gains(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 of each token's probability over the root's."""
        gain = np.zeros(len(word))
        for level, (context, gram) in zip(self.levels, self.contexts(word, at)):
            node = (context >= 0) & level.kept[context]
            named = node & (gram >= 0) & level.listed[gram]
            gain = np.where(node, level.rest[context] + gain, gain)
            gain[named] = level.gain[gram[named]]
        return gain

    def grow(self, grams: np.ndarray, counts: np.ndarray) -> None:
        """Add the next level from its frequent grams."""
        depth = len(self.levels)
        size = self.counts if depth == 0 else self.levels[-1].counts
        context, word = grams // _SHIFT, grams % _SHIFT
        root = self.log_root(self.counts[word]) * np.log(10)
        suffix = root + self._suffix_gain(depth, context, word)
        own = size[context].astype(float)
        listed = counts / own >= LEAST_RATIO * np.exp(suffix)
        given = np.zeros(len(size))
        np.add.at(given, context[listed], counts[listed])
        n_listed = np.bincount(context[listed], minlength=len(size))
        rest = (size - given + DISCOUNT * n_listed) / np.maximum(size, 1)
        p = np.where(listed, (counts - DISCOUNT) / own, 0) + rest[context] * np.exp(suffix)
        with np.errstate(divide="ignore"):
            likelihood = (size - given) * np.log(np.maximum(rest, 1e-300))
        np.add.at(likelihood, context[listed], counts[listed] * (np.log(p[listed]) - suffix[listed]))
        kept = (n_listed > 0) & (likelihood >= LEAST_GAIN) & (rest > 0)
        with np.errstate(divide="ignore"):
            gain = (np.log(p) - root) / np.log(10)
        # One more entry, for index -1: no context, no gram.
        self.levels.append(Level(
            grams, counts, np.append(kept, False), np.append(np.where(kept, np.log10(np.maximum(rest, 1e-300)), 0), 0),
            np.append(listed & kept[context], False), np.append(gain, 0)))

    def _suffix_gain(self, depth: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log of what the longest kept suffix gives the word, over the root."""
        gain = np.zeros(len(word))
        if depth == 0:
            return gain
        # The suffix of a context (gram of the level before) drops its first word.
        words = [self.levels[depth - 1].grams[context] % _SHIFT]
        above = self.levels[depth - 1].grams[context] // _SHIFT
        for level in range(depth - 2, -1, -1):
            words.append(self.levels[level].grams[above] % _SHIFT)
            above = self.levels[level].grams[above] // _SHIFT
        words = words[::-1]  # without the first word, which ``above`` holds now
        for length in range(1, depth + 1):
            own = words[len(words) - length:]
            node = own[0]
            for k, next_word in enumerate(own[1:]):
                known = node >= 0
                node = np.where(known, _place(self.levels[k].grams, np.where(known, node, 0) * _SHIFT + next_word), -1)
            level = self.levels[length - 1]
            here = (node >= 0) & level.kept[node]
            gram = np.full(len(word), -1, np.int64)
            gram[here] = _place(level.grams, node[here] * _SHIFT + word[here])
            named = here & (gram >= 0) & level.listed[gram]
            gain = np.where(here, level.rest[node] + gain, gain)
            gain[named] = level.gain[gram[named]]
        return gain * np.log(10)


def train(docs: DataFrame, n_buckets: int, depth: int = DEPTH) -> tuple[Tree, DataFrame]:
    """The tree in one piece, for corpora that fit the driver, and the counts of
    all words, by bucket. ``score_texts`` deals the same tree instead."""
    counts, total, distinct = _word_counts(docs, n_buckets)
    least = LEAST_COUNT
    words, n = _frequent(counts, least)
    tree = Tree(words, n, total, distinct, [])
    for _ in range(depth):
        shared = docs.sparkSession.sparkContext.broadcast(tree)

        def grams(hashes, at, shared=shared):
            tree = shared.value
            word = _place(tree.words, hashes)
            known = tree.contexts(word, at)
            context = np.full(len(word), -1, np.int64)
            context[1:] = known[-1][1][:-1] if known else word[:-1]
            context[at[:-1]] = -1
            # A frequent gram's last words are a frequent gram themselves.
            wanted = (context >= 0) & (word >= 0) & (known[-1][1] >= 0 if known else True)
            return (context[wanted] * _SHIFT + word[wanted]).view(np.uint64)

        found, n = _frequent(_counted(docs, grams, n_buckets), least)
        tree.grow(found.view(np.int64), n)
    return tree, counts
