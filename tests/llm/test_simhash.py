"""SimHash near-duplicates against all pairs of fingerprints."""

from __future__ import annotations

import random

import xxhash
from llm_helpers import DOCUMENT, pairs, prose, same

from claimlink.llm import simhash
from claimlink.llm.common import staging
from claimlink.llm.graph import components


def fingerprint(text, size=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(docs, distance=2):
    prints = {fingerprint(t) for _, t in docs}
    name = {p: p for p in prints}

    def find(p):
        while name[p] != p:
            p = name[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= distance:
                name[find(a)] = find(b)
    smallest = {}
    for i, t in docs:
        root = find(fingerprint(t))
        known = smallest.get(root)
        smallest[root] = i if known is None else known if i is None else min(known, i)
    return [(i, f"{fingerprint(t):016x}", smallest[find(fingerprint(t))]) for i, t in docs]


def near_copies(session, copies=60):
    rng = random.Random(9)
    text = prose(rng, 300).split()
    rows = []
    for i in range(copies):
        words = list(text)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((1000 - i, " ".join(words), "", "", 0))
    rows += [(i, prose(rng, rng.randrange(40)), "", "", 0) for i in range(40)]
    return session.createDataFrame(rows, DOCUMENT).repartition(3)


def test_odd_documents(odd_documents):
    same(simhash.near_duplicates(odd_documents), linked(pairs(odd_documents)))


def test_sample(sample_documents):
    same(simhash.near_duplicates(sample_documents), linked(pairs(sample_documents)))


def test_near_copies_with_any_blocks(session):
    docs = near_copies(session)
    want = linked(pairs(docs))
    assert len({c for _, _, c in want}) < len(want) - 30
    same(simhash.near_duplicates(docs), want)
    same(simhash.near_duplicates(docs, blocks=4), want)


def test_one_of_each_group_stays(session, odd_documents):
    docs = pairs(odd_documents)
    want = {c for i, _, c in linked(docs) if i is not None}
    kept = simhash.keep_one_each(odd_documents)
    assert kept.schema == odd_documents.schema
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 1


def test_rows_that_share_an_id_are_judged_by_their_own_group(session):
    rng = random.Random(15)
    copied, *own = [prose(rng, 100) for _ in range(4)]
    rows = [(3, copied), (7, copied), *[(7, own[0])] * 2, (7, own[1]), (8, own[1]), (9, own[2])]
    docs = session.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCUMENT).repartition(3)
    kept = simhash.keep_one_each(docs)
    assert kept.schema == docs.schema
    same(kept, [(i, t, "", "", 0) for i, t in (rows[0], rows[2], rows[4], rows[6])])


def test_no_documents(no_documents):
    assert simhash.near_duplicates(no_documents).collect() == []
    assert simhash.keep_one_each(no_documents).collect() == []


def test_tree_finds_all_within_the_radius():
    rng = random.Random(2)
    values = list({rng.getrandbits(10) for _ in range(300)})
    tree = simhash.Tree(values[0])
    for v in values[1:]:
        tree.add(v)
    for radius in (0, 1, 2, 3):
        for v in values[:40]:
            near = [x for x in values if (x ^ v).bit_count() <= radius]
            assert sorted(tree.near(v, radius)) == sorted(near)


def test_shards_hold_every_close_pair():
    masks = simhash.shard_masks()
    assert len(masks) == 28
    rng = random.Random(8)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        assert any(a & m == b & m for m in masks)
    assert all((~m & (1 << 64) - 1).bit_count() == 16 for m in masks)


def test_components_of_a_long_chain(session):
    rng = random.Random(6)
    names = rng.sample(range(-500, 500), 200)
    links = [(a, b) for a, b in zip(names, names[1:], strict=False)] + [(900, 901), (None, 3)]
    df = session.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(df, staging(session)).collect()}
    assert found == {n: min(names) for n in names} | {900: 900, 901: 900}
