"""Words, shingles, pre-tokens and the operators on them, against plain Python."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cellmend.llm import packing, pretokens, text_arrays as ta
from cellmend.llm.packing import pack_documents, plan
from cellmend.llm.pretokens import Encoder
from cellmend.llm.token_counts import count_tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="aB é\n\t'1<|>-٣漢", max_size=40), max_size=8)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array([*texts, None], pa.string())
    got = []
    for words in ta.words_of(column, lower=True):
        got += [words.data[s:e].tobytes().decode() for s, e in zip(words.starts, words.ends)]
        assert len(words.first) == len(words.rows) + 1
    assert got == [w for t in texts for w in WORD.findall(lowered(t))]


def shingles(text):
    words = WORD.findall(lowered(text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_shingle_sets_have_the_right_overlaps(texts):
    sets = []
    for words in ta.words_of(pa.array(texts, pa.string()), lower=True):
        tokens, at = ta.shingle_sets(words)
        sets += [tokens[i:j] for i, j in zip(at[:-1], at[1:])]
    want = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in want]
    for a, b, x, y in zip(sets, sets[1:], want, want[1:]):
        assert len(np.intersect1d(a, b)) == len(x & y)


PIECES = ["'s", "'re", "'LL", " 's", "<|endoftext|>", "\x85", "́", "İ", "Σ", "😀", "…", "’", "ß", "Œ"]


@pytest.mark.parametrize("name, words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_ids_are_those_of_the_tokenizer(name, words):
    rnd = random.Random(3)
    letters = [*"aB sStTrReEvVmMlLdD  \n\t\r 12,.!<|>-_éÉ", *PIECES]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    path = public_tokenizers.path(name)
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]
    encoder, got, lengths = Encoder(path, words), [None] * len(texts), np.zeros(len(texts), int)
    for rows, flat, at in encoder.ids(pa.array(texts)):
        for row, i, j in zip(rows, at[:-1], at[1:]):
            got[row] = flat[i:j].tolist()
    assert got == want
    for rows, n in encoder.lengths(pa.array(texts)):
        lengths[rows] = n
    assert lengths.tolist() == [len(w) for w in want]


def test_a_full_cache_begins_anew(monkeypatch):
    monkeypatch.setattr(pretokens, "CACHE_ENTRIES", 5)
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"), True)
    for text in ("one two three four", "five six seven eight", "one nine ten"):
        want = len(encoder.tokenizer.encode(text, add_special_tokens=False).ids)
        assert [n for _, n in encoder.lengths(pa.array([text]))][0].tolist() == [want]


def test_token_counts_of_odd_rows(documents):
    path = public_tokenizers.path("word_bpe_49k.json")
    long = "Wörd's 12 " * 30_000
    rows = [(1, "Hello World's"), (1, "Hello World's"), (2, None), (3, ""), (None, "a b"), (4, long)]
    got = count_tokens(documents(rows), path).collect()
    tokenizer = Tokenizer.from_file(path)
    want = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids))
            for i, t in rows]
    key = lambda r: repr(tuple(r))
    assert sorted([tuple(r)[:3] for r in got], key=key) == sorted(want, key=key)
    assert [r.over_limit for r in got] == [r.n_tokens > 2048 for r in got]
    assert count_tokens(documents([]), path).count() == 0


def test_plan_fills_gaps_with_two():
    """6 + 3 leaves one free; 6 + (2 + 2) leaves none."""
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = 1, 1, 2
    places = plan(counts, 10)
    first = places.length[places.sequence == 0].tolist()
    assert sorted(first) == [2, 6] and places.uses[(places.sequence == 0) & (places.length == 2)] == 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_plan_places_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=21).astype(np.int64) if lengths else np.zeros(21, np.int64)
    places = plan(counts, 20)
    filled = defaultdict(list)
    for length in set(lengths):
        for rank in range(counts[length]):
            at = np.flatnonzero((places.length == length) & (places.first <= rank))[-1]
            step = rank - places.first[at]
            filled[places.sequence[at] + step // places.uses[at]].append(
                (places.offset[at] + step % places.uses[at] * length, length))
    for pieces in filled.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 20


def test_packing_keeps_every_token(documents):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["alpha", "be's", "γ", "1234"]) for _ in range(rnd.choice([0, 3, 40, 900])))
             for _ in range(60)] + [None, "", "x" * 9000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id")]
    got = pack_documents(documents(rows), path).collect()
    tokenizer = Tokenizer.from_file(path)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.length for r in own[1:]] == [1024] * (len(own) - 1) and sum(r.length for r in own) == len(ids)
        assert len(own) == -(-len(ids) // 1024)
        for r in own:
            part = np.array(ids[r.start:r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= packing.SEQUENCE_TOKENS
    total = sum(r.length for r in got)
    assert len(sequences) <= 1.1 * total / 1024 + 2
    assert pack_documents(documents([]), path).count() == 0
