"""Containment of benchmark items against sets of shingles."""

from __future__ import annotations

import random

import pytest
from llm_helpers import DATA, DOCUMENT, pairs, prose, same

from claimlink.llm import decontaminate as d


def shingles(words, k):
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def expected(docs, items):
    for i, t in docs:
        words = (t or "").encode().lower().split()
        for j, text in set(items):
            own = (text or "").encode().lower().split()
            if not own or j is None:
                continue
            k = min(5, len(own))
            want = shingles(own, k)
            n = len(want & shingles(words, k))
            if 10 * n >= 8 * len(want):
                yield i, j, len(want), n, n / len(want)


@pytest.fixture(scope="module")
def planted(session):
    rng = random.Random(4)
    texts = [prose(rng, n) for n in (4, 5, 9, 12, 40, 41, 60)]
    items = [(j, t) for j, t in enumerate(texts)]
    items += [(50, None), (51, ""), (None, texts[4]), (0, texts[0]), (52, "É" + texts[5].upper())]
    rows = []
    for i in range(120):
        own = rng.choice(texts).split()
        for _ in range(rng.randrange(4)):
            own[rng.randrange(len(own))] = "other"
        parts = [prose(rng, rng.randrange(300)), " ".join(own).title(), prose(rng, 20)]
        rows.append((i, "\n".join(parts), "", "", 0))
    rows += [(7, rows[7][1], "", "", 0), (200, None, "", "", 0), (None, texts[6], "", "", 0)]
    return (
        session.createDataFrame(rows, DOCUMENT).repartition(3),
        session.createDataFrame(items, "item_id long, text string"),
        items,
    )


@pytest.mark.parametrize("block", [1_000_000, 60])
def test_planted_items(planted, block):
    docs, benchmark, items = planted
    want = list(expected(pairs(docs), items))
    assert len({w[1] for w in want}) > 5
    same(d.contaminated_pairs(docs, benchmark, block_words=block), want)


@pytest.mark.parametrize("block", [1_000_000, 60])
def test_contaminated_documents_go(planted, block):
    docs, benchmark, items = planted
    bad = {w[0] for w in expected(pairs(docs), items)}
    kept = d.decontaminate(docs, benchmark, block_words=block)
    assert kept.schema == docs.schema
    same(kept.select("doc_id"), [(i,) for i, _ in pairs(docs) if i not in bad])


def test_odd_documents(odd_documents, session):
    items = [(i, t) for i, t in pairs(odd_documents) if t and len(t) < 2000]
    benchmark = session.createDataFrame(items, "item_id long, text string")
    same(d.contaminated_pairs(odd_documents, benchmark), expected(pairs(odd_documents), items))


def test_empty_tables(no_documents, sample_documents, session):
    benchmark = session.read.parquet(f"{DATA}/benchmark.parquet")
    assert d.contaminated_pairs(no_documents, benchmark).collect() == []
    none = benchmark.limit(0)
    assert d.contaminated_pairs(sample_documents, none).collect() == []
    assert d.decontaminate(sample_documents, none).count() == sample_documents.count()


def test_sketch_holds_one_of_what_cannot_be_missed():
    from fractions import Fraction

    for t in ("0.8", "0.5", "1.0"):
        least = Fraction(t)
        for n in range(1, 300):
            may_miss = n - -(-least.numerator * n // least.denominator)
            assert min(n, may_miss + 1) <= d.sketch_size(n, least) <= n
