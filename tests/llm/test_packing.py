"""Packing: pieces against the tokenizer itself, sequences against the definition."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import pairs, prose
from tokenizers import Tokenizer

from claimlink.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, docs, tokenizer, capacity=1024):
    """Every piece, and gapless sequences within the capacity."""
    want = []
    for i, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            want.append((i, k, a, b - a, crc))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), sum(w[3] for w in want)


def test_odd_documents(odd_documents, tokenizer):
    rows = packing.pack(odd_documents).collect()
    check(rows, pairs(odd_documents), tokenizer)


def test_sample_is_packed_tightly(sample_documents, tokenizer):
    rows = packing.pack(sample_documents).collect()
    sequences, tokens = check(rows, pairs(sample_documents), tokenizer)
    assert sequences <= 1.02 * tokens / 1024 + 1


def test_several_shards(sample_documents, tokenizer):
    rows = packing.pack(sample_documents, shard_pieces=50).collect()
    check(rows, pairs(sample_documents), tokenizer)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_id_are_dealt_to_all_shards(session, tokenizer, doc_id):
    docs = session.createDataFrame([(doc_id, "one two")] * 300, "doc_id long, text string")
    rows = packing.pack(docs, shard_pieces=50).collect()
    check(rows, pairs(docs), tokenizer)
    held = Counter(r.sequence_id >> 40 for r in rows)
    assert len(held) == 6 and max(held.values()) < 100


def test_no_documents(no_documents):
    assert packing.pack(no_documents).collect() == []


def test_long_text_in_segments(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "SEGMENT", 100)
    encode = packing.Encoder(cached=50)
    rng = random.Random(3)
    for text in (prose(rng, 500), "a  b\n\n c\t" * 80, "no blank" + "x" * 400, "it's\n'll " * 50):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert encode(text) == np.array(ids, "<u4").tobytes()


def test_added_tokens_are_one_id(monkeypatch, tokenizer):
    """In the middle, at both ends, side by side, incomplete, and across the edge of a segment."""
    end = "<|endoftext|>"
    assert 50256 in tokenizer.encode(f"x {end} y", add_special_tokens=False).ids
    rng = random.Random(7)
    texts = [f"x {end} y", end, f"{end}start", f"stop{end}", f"{end}{end} {end}", end[:-1],
             f"{end[:5]} {end[5:]}", end.upper(), f"{prose(rng, 400)} {end}{prose(rng, 400)}"]
    for segment in (10, 40, 1_000_000):
        monkeypatch.setattr(packing, "SEGMENT", segment)
        encode = packing.Encoder()
        for text in texts:
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            assert encode(text) == np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("total", [1, 1023, 1024, 1025, 2048, 5000])
def test_pieces_cover_a_document(total):
    pieces = packing.pieces_of(total, 1024)
    assert [s for s, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]]
    assert sum(n for _, n in pieces) == total
    assert all(n == 1024 for _, n in pieces[1:]) and 0 < pieces[0][1] <= 1024


def test_local_search_empties_sequences():
    """Best fit needs three sequences here, exchanges bring them to two."""
    lengths = [6, 5, 5, 4, 4, 4, 2]
    bins = packing.Bins(lengths, 15)
    bins.held = [[0, 3, 4], [1, 2], [5, 6]]
    bins.free = [1, 5, 9]
    squares = sum((15 - f) ** 2 for f in bins.free)
    bins.improve()
    assert sum(map(len, bins.held)) == 7
    assert [sum(lengths[k] for k in h) + f for h, f in zip(bins.held, bins.free, strict=True)] \
        == [15] * 3
    assert sum((15 - f) ** 2 for f in bins.free) > squares
    assert sum(bool(h) for h in bins.held) == 2


def test_search_keeps_all_pieces_and_never_needs_more():
    rng = random.Random(5)
    for _ in range(20):
        lengths = [rng.randrange(1, 100) for _ in range(200)]
        plain = packing.Bins(lengths, 100)
        plain.best_fit()
        sequence, offset = packing.pack_lengths(lengths, 100)
        fill = defaultdict(int)
        for s, n in zip(sequence, lengths, strict=True):
            fill[s] += n
        assert max(fill.values()) <= 100
        assert len(fill) <= len(plain.held)
        assert max(o + n for o, n in zip(offset, lengths, strict=True)) <= 100


def exchanges_left(bins) -> int:
    """Exchanges for none, one or two smaller pieces that would raise the sum of squared fills."""
    under = [b for b, f in enumerate(bins.free) if f and bins.held[b]]
    left = 0
    for a in under:
        for b in under:
            held = [bins.lengths[k] for k in bins.held[b]]
            back = {0, *held, *(x + y for x, y in combinations(held, 2))}
            for size in {bins.lengths[k] for k in bins.held[a]} if a != b else ():
                rest = {bins.free[b] - size + less for less in back if less < size}
                left += any(0 <= r < bins.free[a] for r in rest)
    return left


@pytest.mark.parametrize("least, most", [(1, 100), (15, 30), (25, 45), (30, 60)])
def test_search_ends_only_when_no_exchange_is_left(least, most):
    rng = random.Random(4)
    bins = packing.Bins([rng.randrange(least, most) for _ in range(600)], 100)
    bins.best_fit()
    bins.improve()
    assert sorted(k for h in bins.held for k in h) == list(range(600))
    assert exchanges_left(bins) == 0


def test_search_sees_pieces_far_back_in_a_sequence():
    """Only the last two of 42 pieces make room for the other sequence's one."""
    lengths = [1] * 40 + [20, 25, 50]
    bins = packing.Bins(lengths, 90)
    bins.held, bins.free = [list(range(42)), [42]], [5, 40]
    bins.improve()
    assert sorted(bins.free) == [0, 45]


def test_search_starts_from_every_underfull_sequence():
    """5,000 emptier sequences have no exchange; the two behind them have."""
    lengths = [60] * 5_000 + [45, 50, 46, 49]
    bins = packing.Bins(lengths, 100)
    bins.held = [[k] for k in range(5_000)] + [[5_000, 5_001], [5_002, 5_003]]
    bins.free = [40] * 5_000 + [5, 5]
    bins.improve()
    assert sorted(bins.free[5_000:]) == [1, 9]


def test_usual_parts_are_the_vocabularys():
    import regex

    ours, theirs = packing._usual_parts(), regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(8)
    usual = "\t\n\r '" * 40 + "".join(chr(c) for c in (*range(0x20, 0x7F), *range(0xA1, 0x250)))
    for _ in range(500):
        text = "".join(rng.choice(usual) for _ in range(60))
        assert ours.findall(text) == theirs.findall(text)
