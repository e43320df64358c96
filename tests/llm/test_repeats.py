"""Suffix-array and substring dedup against sets of all runs."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_helpers import DOCUMENT, pairs, prose, same

from claimlink.llm import repeats, suffix_array, substring_dedup, suffix_dedup
from claimlink.llm.common import staging
from claimlink.llm.repeats import smallest_of_windows


def every_repeat(docs, least):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) with all strings in a counter."""
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(t[p : p + least] for _, t in texts for p in range(len(t) - least + 1))
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - least + 1):
            if seen[t[p : p + least]] > 1:
                gone[p : p + least] = b"\1" * least
        spans = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        yield i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def every_later_repeat(docs, least):
    """(doc_id, n_words, n_removed, kept_sha256) with the first place of every run in a dict."""
    first = {}
    rank = lambda i: (i is not None, i or 0)
    tokens = [(i, (t or "").encode().split()) for i, t in docs]
    for i, w in tokens:
        for p in range(len(w) - least + 1):
            run = tuple(w[p : p + least])
            first[run] = min(first.get(run, (rank(i), p)), (rank(i), p))
    for i, w in tokens:
        gone = bytearray(len(w))
        for p in range(len(w) - least + 1):
            if first[tuple(w[p : p + least])] < (rank(i), p):
                gone[p : p + least] = b"\1" * least
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        yield i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()


def test_suffix_dedup_on_odd_documents(odd_documents):
    same(suffix_dedup.remove_repeats(odd_documents), every_repeat(pairs(odd_documents), 400))


@pytest.mark.parametrize("doc_id", [None, 5])
def test_repeated_rows_ship_each_place_once(session, doc_id):
    rng = random.Random(12)
    passage = prose(rng, 200)
    texts = [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(2)]
    rows = [(doc_id, texts[0])] * 40 + [(6, texts[1])] * 40
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(4)
    runs, store = suffix_dedup.byte_runs(), staging(session)
    grouped = store(repeats.classes(repeats.occurrences(docs, runs)), "classes")
    contexts = repeats.shipped(docs, grouped.filter("contexts > 1"), runs)
    places = [(r.anchor, r.doc_id, r.key, r.pos) for r in contexts.collect()]
    assert len(places) == len(set(places)) > 0
    same(suffix_dedup.remove_repeats(docs), every_repeat(pairs(docs), 400))


def test_suffix_dedup_on_the_sample(sample_documents):
    same(suffix_dedup.remove_repeats(sample_documents), every_repeat(pairs(sample_documents), 400))


def test_substring_dedup_on_odd_documents(odd_documents):
    same(
        substring_dedup.remove_later_repeats(odd_documents),
        every_later_repeat(pairs(odd_documents), 20),
    )


def test_substring_dedup_on_the_sample(sample_documents):
    same(
        substring_dedup.remove_later_repeats(sample_documents),
        every_later_repeat(pairs(sample_documents), 20),
    )


@pytest.mark.parametrize("most", [4000, 3])
def test_hot_anchor(session, most):
    """A passage shorter than a run in very many documents, some sharing a little more."""
    rng = random.Random(3)
    line = prose(rng, 16)
    ends = [prose(rng, 5) for _ in range(6)]
    rows = [
        (i, f"{rng.choice(ends)} {line} {rng.choice(ends)} {prose(rng, 30, 10_000)}", "", "", 0)
        for i in range(300)
    ]
    docs = session.createDataFrame(rows, DOCUMENT).repartition(5)
    same(
        substring_dedup.remove_later_repeats(docs, 20, 6, most), every_later_repeat(pairs(docs), 20)
    )
    same(suffix_dedup.remove_repeats(docs, 110, 40, most), every_repeat(pairs(docs), 110))


def test_no_documents(no_documents):
    assert suffix_dedup.remove_repeats(no_documents).collect() == []
    assert substring_dedup.remove_later_repeats(no_documents).collect() == []


@pytest.mark.parametrize("thin", [0.001, 30])
def test_suffix_array_and_prefixes(monkeypatch, thin):
    monkeypatch.setattr(suffix_array, "THIN_BUCKET", thin)
    rng = random.Random(1)
    for _ in range(300):
        t = bytes(rng.randrange(rng.choice([1, 2, 4, 256])) for _ in range(rng.randrange(80)))
        t *= rng.choice([1, 1, 3])
        x = np.frombuffer(t, np.uint8)
        order = suffix_array.suffix_array(x)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        before, common = suffix_array.common_prefixes(x, order)
        for a, b in zip(order, order[1:], strict=False):
            assert before[b] == a
            n = common[b]
            assert t[a : a + n] == t[b : b + n] and t[a + n : a + n + 1] != t[b + n : b + n + 1]


@pytest.mark.parametrize("thin", [0.001, 30, 100, 10**9])
@pytest.mark.parametrize("unit", [b"a", b"ab", b"abracadabra", b"\x00\xff", b"mississippi "])
def test_suffix_array_of_long_runs(monkeypatch, thin, unit):
    """Periods are what recursion goes deep on; every suffix is one more period than another."""
    monkeypatch.setattr(suffix_array, "THIN_BUCKET", thin)
    for text in (unit * (700 // len(unit)), unit * 40 + b"b" + unit * 40, b"b" * 90 + unit * 30):
        order = suffix_array.suffix_array(np.frombuffer(text, np.uint8))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_recurses_to_the_end(monkeypatch):
    """Strings of names get shorter until all names differ, by induction at every level."""
    seen, induce = [], suffix_array._induce

    def watched(s, *rest):
        seen.append(len(s))
        return induce(s, *rest)

    monkeypatch.setattr(suffix_array, "_induce", watched)
    text = (prose(random.Random(8), 4_000) * 3).encode()
    order = suffix_array.suffix_array(np.frombuffer(text, np.uint8))
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    levels = sorted(set(seen), reverse=True)
    assert len(levels) > 3
    assert all(b <= a // 2 for a, b in zip(levels, levels[1:], strict=False))


def test_long_runs_take_linear_time():
    """A run of one byte, or a period, costs what other text of its length does."""
    rounds = suffix_array._rounds(np.array([3, 3, 3, 1, 3, 1, 1, 0]), 5)
    assert rounds == 3 + 2 + 1
    n = 200_000
    for unit in (b"a", b"ab"):
        order = suffix_array.suffix_array(np.frombuffer(unit * (n // len(unit)), np.uint8))
        starts = [np.arange(k, n, len(unit))[::-1] for k in range(len(unit))]
        assert np.array_equal(order, np.concatenate(starts))


def test_smallest_of_windows():
    rng = np.random.default_rng(2)
    for size in (1, 2, 5, 16):
        h = rng.integers(0, 12, 60).astype(np.uint64)
        want = {
            j
            for i in range(len(h) - size + 1)
            for j in range(i, i + size)
            if h[j] == h[i : i + size].min()
        }
        assert set(smallest_of_windows(h, size).tolist()) == want


def test_segments_do_not_matter(monkeypatch):
    """Anchors of a long text do not depend on where it is cut for hashing."""
    text = prose(random.Random(4), 3000).encode()
    whole = suffix_dedup.byte_runs().anchors(text)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    cut = suffix_dedup.byte_runs().anchors(text)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()
