import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs

from quayside.llm import packing
from quayside.llm.word_ids import SpacedWordIds
from tests.llm.conftest import awkward_rows, frame, prose


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


ODD = [
    "Don't you'LL we've it'S 's 'tis", "A.B,C;D!!! (x) [y] {z} #$% &&& ***", "a  b   c    d", " lead", "trail ", "trail  ", "  \n\n  x \n y\n\n\nz\t\tw \t v",
    "a  b  c \n d", "日本語 テスト 한국어 עברית", "x\x1cy \x1c z\x1f", "\x85a　 b", "<|endoftext|>hi <|endoftext|> <|endoftext|>x", "ÀÉÎ ÿ Œ ß ẞ İ ı Å Å", "x_y __ _a_",
    "12 345 6a7 ½ ² Ⅷ", "​ ﻿ \x00 \x7f", "a\r\nb\r\n\r\nc", "word, word; word-word 'quoted' \"dq\"", "\n", " ", "  ", "é\nÉ é  é", "naïve café!? ÆØ", "a b   c",
]


def test_words_encode_as_whole_texts_do(tokenizer):
    texts = ODD + [r[1] or "" for r in awkward_rows() if len(r[1] or "") < 20_000]
    words, data = SpacedWordIds(tokenizer.to_str(), 0, most=20), [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(d) for d in data]))).tolist()
    for _ in range(2):
        ids, starts = words.ids(b"".join(data), offs)
        for k, t in enumerate(texts):
            assert ids[starts[k] : starts[k + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 0], t


@settings(max_examples=300, deadline=None)
@given(hs.text(alphabet=list(" \n\t\r.'sa") + ["é", " ", "　", "\x1c", "A", "1", "日"], max_size=14))
def test_any_white_space(text):
    from tokenizers import Tokenizer

    if not hasattr(test_any_white_space, "pair"):
        t = Tokenizer.from_file(packing.default_tokenizer())
        test_any_white_space.pair = t, SpacedWordIds(t.to_str(), 0)
    t, words = test_any_white_space.pair
    data = text.encode()
    assert words.ids(data, [0, len(data)])[0].tolist() == [*t.encode(text, add_special_tokens=False).ids, 0]


def fewest(lengths, capacity):
    """The fewest sequences, by trying all ways."""
    best = [len(lengths)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for i in {r: i for i, r in enumerate(rooms) if r >= lengths[k]}.values():
            rooms[i] -= lengths[k]
            go(k + 1, rooms)
            rooms[i] += lengths[k]
        go(k + 1, [*rooms, capacity - lengths[k]])

    go(0, [])
    return best[0]


def check_plan(counts):
    capacity, entries, got = len(counts) - 1, packing.plan(counts), np.zeros_like(counts)
    for pattern, n in entries:
        assert n > 0 and sum(x * k for x, k in pattern) <= capacity
        for x, k in pattern:
            got[x] += k * n
    assert got.tolist() == counts.tolist()
    return sum(n for _, n in entries)


@settings(max_examples=60, deadline=None)
@given(hs.lists(hs.integers(1, 24), min_size=1, max_size=11))
def test_close_to_the_fewest(lengths):
    n, best = check_plan(np.bincount(lengths, minlength=25).astype(np.int64)), fewest(sorted(lengths, reverse=True), 24)
    assert best <= n <= best + 1


@pytest.mark.parametrize("seed", range(4))
def test_exact_complements_are_found(seed):
    rng, lengths = np.random.default_rng(seed), []
    for _ in range(300):  # sequences that can be filled exactly by two to four pieces
        cuts = np.sort(rng.choice(np.arange(1, 256), rng.integers(1, 4), replace=False))
        lengths += np.diff([0, *cuts, 256]).tolist()
    assert check_plan(np.bincount(lengths, minlength=257).astype(np.int64)) <= 303


def test_tables_of_sums():
    rng = np.random.default_rng(5)
    counts = (rng.integers(0, 3, 60) * rng.integers(0, 2, 60)).astype(np.int64)
    counts[0] = 0
    c = packing.Complements(counts)
    bag = [x for x, n in enumerate(counts) for _ in range(n)]
    pairs = {a + b for i, a in enumerate(bag) for b in bag[i + 1 :]}
    triples = {a + b + d for i, a in enumerate(bag) for j, b in enumerate(bag[i + 1 :], i + 1) for d in bag[j + 1 :]}
    for gap in range(1, 60):
        assert (c.pair(gap) is not None) == (gap in pairs) and (c.triple(gap) is not None) == (gap in triples)
        for found in filter(None, (c.pair(gap), c.triple(gap))):
            assert sum(found) == gap and all(found.count(x) <= counts[x] for x in found)
    assert (c.free == counts).all()


def brute(rows, tokenizer, capacity):
    out = []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        start, end = 0, (len(ids) - 1) % capacity + 1
        for piece in range(-(-len(ids) // capacity)):
            out.append((r[0], piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
            start, end = end, end + capacity
    return out


def check(df, rows, tokenizer, capacity):
    got = df.collect()
    assert sorted(map(repr, [tuple(r)[:5] for r in got])) == sorted(map(repr, brute(rows, tokenizer, capacity)))
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), got


@pytest.mark.parametrize("capacity", [64, 2048])
def test_brute_force(spark, tokenizer, capacity):
    rows = awkward_rows() + [(1000 + k, t, "en", "a", 0) for k, t in enumerate(ODD)] + [(k, prose(k, 1 + k % 50), "en", "a", 0) for k in range(200)]
    rows += [(7, "the same row", "en", "hot", 1)] * 150
    n, got = check(packing.pack(frame(spark, rows, 5), capacity=capacity), rows, tokenizer, capacity)
    assert n <= -(-sum(r["length"] for r in got) // capacity) + 1


def test_sequences(spark, tokenizer):
    rows = [(k, prose(k, 3 + k % 40), "en", "a", 0) for k in range(60)]
    packed = packing.pack(frame(spark, rows), capacity=128, keep_ids=True)
    got = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        row = got[r["sequence_id"]]
        piece = row["ids"][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert piece == r["ids"] and zlib.crc32(piece) == r["ids_crc32"] and len(row["ids"]) == 4 * row["n_tokens"]


def test_empty_table(nothing):
    assert packing.pack(nothing).collect() == []
