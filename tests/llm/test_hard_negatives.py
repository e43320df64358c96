"""Hard negatives against brute force over all pairs."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from llm_helpers import DATA, same

from claimlink.llm import hard_negatives as hn
from claimlink.llm import queries

EMBEDDING = "vec_id long, embedding array<float>, label int"


def usable(row):
    i, vector, label = row
    return (i is not None and label is not None and vector is not None
            and all(v is not None and math.isfinite(v) for v in vector))


def expected(rows, every=50, positives=5, negatives=3, low=50, high=95):
    taking = {(i, label, tuple(math.floor(256 * float(v)) for v in vector))
              for i, vector, label in filter(usable, rows)}
    length = max((len(x) for *_, x in taking), default=0)
    full = [(i, label, x + (0,) * (length - len(x)), (i, label, x)) for i, label, x in taking]
    result = []
    for i, label, x, own in full:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j, k)
                        for j, k, y, other in full if other != own)
        liked = [(-s, j) for s, j, k in scored if k == label][:positives]
        for score, j in liked:
            hard = [(-s, n) for s, n, k in scored
                    if k != label and low * score <= -100 * s <= high * score][:negatives]
            result += [(i, j, r, n, score, s) for r, (s, n) in enumerate(hard, 1)]
    return result


def mined(df, every=50, **options):
    taking = hn.labelled_vectors(df, df["label"])
    return hn.mine(taking, lambda i: i % every == 0, **options)


def triples(df):
    return [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]


def test_whole_table_against_its_sql(session):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    name = "op11_hard_negatives"
    want = connection.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](session, DATA)
    assert got.columns == want.columns
    rows = want.fetchall()
    assert len(rows) > 50
    same(got, rows)


@pytest.fixture(scope="module")
def odd(session):
    """Clusters, ties, repeated rows, copies of one vector, zeros, nulls, other lengths, clashes."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.2).tolist(), int(rng.integers(3)))
            for i in range(400)]
    hot = rows[0][1]
    rows += [(1000 + i, hot, i % 3) for i in range(200)]
    rows += [rows[50], rows[50], (50, rows[51][1], rows[50][2]), (50, rows[52][1], 2)]
    rows += [(2000, [0.0] * 8, 1), (2001, [0.0] * 8, 2), (2050, [], 0), (2100, [1.0, -1.0], 1),
             (2150, [0.5] * 12, 1), (None, hot, 0), (2200, None, 0), (2250, hot, None),
             (2300, [math.nan] * 8, 0), (2350, [None] * 8, 0), (2400, [math.inf] * 8, 0)]
    df = session.createDataFrame(rows, EMBEDDING)
    extra = [f"'c' AS {c}" for c in ("row", "x", "norm", "anchor", "window", "block", "place")]
    return df.selectExpr("*", *extra).repartition(6)


def test_odd_rows(odd):
    want = expected(triples(odd))
    assert len(want) > 50
    same(mined(odd), want)


@pytest.mark.parametrize("options", [
    {"positives": 1, "negatives": 1},
    {"positives": 300, "negatives": 2},
    {"low": 0, "high": 100, "negatives": 40},
    {"low": 95, "high": 95},
])
def test_other_windows(odd, options):
    same(mined(odd, **options), expected(triples(odd), **options))


def test_blocks_tasks_and_pending_candidates(odd, monkeypatch):
    """Small blocks, tasks, slabs and lists change nothing."""
    monkeypatch.setattr(hn, "BLOCK_BYTES", 500)
    monkeypatch.setattr(hn, "TASK_ROWS", 150)
    same(mined(odd), expected(triples(odd)))


def test_candidates_are_dropped_early_without_loss(odd, monkeypatch):
    rows = hn.labelled_vectors(odd, odd["label"])
    store = hn.staging(rows.sparkSession)
    placed = hn.Vectors.of(hn.placed(rows, store).toArrow())
    anchors = placed.take(np.flatnonzero(placed.vec_id % 50 == 0))
    shape = len(anchors), 1
    limit = np.iinfo(np.int64)
    block = hn.Block(anchors, np.full(shape, limit.min), np.full(shape, limit.max), True, 4)
    found = []
    for pending in (1, 10**9):
        monkeypatch.setattr(hn, "PENDING", pending)
        search = hn.Search(block)
        for at in range(0, len(placed), 50):
            search.add(placed.take(slice(at, at + 50)))
        found.append([c.tolist() for c in search.found()])
    assert found[0] == found[1]


@pytest.mark.parametrize("rows", [
    [],
    [(50, None, 1)],
    [(1, [0.5, 1.0], 0), (2, [0.5, 1.0], 1)],
    [(50, [0.5, 1.0], 0), (2, [0.5, 1.0], 1)],
    [(50, [], 0), (2, [], 0), (3, [], 1)],
    [(50, [-1.0], 0), (2, [1.0], 0), (3, [-0.7], 1)],
])
def test_few_rows(session, rows):
    df = session.createDataFrame(rows, EMBEDDING)
    result = mined(df)
    same(result, expected(rows))
    assert result.columns == [c.split()[0] for c in hn.RESULT.split(", ")]


def test_bounds_hold_every_score():
    rng = np.random.default_rng(3)
    for scale in (1, 300, 10_000):
        x = rng.integers(-scale, scale + 1, size=(300, 5))
        x[:20] = x[0]
        x[20:40] = -x[0]
        x[40] = 0
        plain = x.astype(float)
        norm = np.linalg.norm(plain, axis=1)
        reference = hn.directions(plain)
        cosine = plain @ reference.T / np.where(norm > 0, norm, 1)[:, None]
        rows = np.arange(len(x))
        angles = np.arccos(np.clip(cosine, -1, 1))
        all_rows = hn.Vectors(rows, rows, rows % 3, x, norm, angles)
        for at in ([0], [40], slice(0, 25), slice(30, 60), slice(0, 300)):
            slab = all_rows.take(at)
            lower, upper = hn.score_bounds(all_rows, slab)
            got = x @ slab.x.T
            assert (got >= lower[:, None]).all() and (got <= upper[:, None]).all()


def test_slabs_outside_the_windows_are_not_scored():
    """In two opposite clusters an anchor is scored against its own only."""
    rng = np.random.default_rng(8)
    centre = rng.normal(size=16)
    x = np.floor(256 * np.concatenate([centre + rng.normal(size=(200, 16)) * 0.05,
                                       -centre + rng.normal(size=(200, 16)) * 0.05])).astype(int)
    norm = np.linalg.norm(x, axis=1)
    reference = hn.directions(x.astype(float))
    angles = np.arccos(np.clip(x @ reference.T / norm[:, None], -1, 1))
    rows = np.arange(400)
    placed = hn.Vectors(rows, rows, rows * 0, x, norm, angles)
    anchors = placed.take(slice(0, 10))
    low = (0.8 * norm[:10] ** 2).astype(int)[:, None]
    search = hn.Search(hn.Block(anchors, low, low * 2, True, 3))
    for at in range(0, 400, 100):
        search.add(placed.take(slice(at, at + 100)))
    assert search.scored == 10 * 200


def test_scores_are_exact_or_refused():
    a = np.array([[2**30, 2**30 - 1]])
    assert hn.scores(a, a)[0, 0] == 2**60 + (2**30 - 1) ** 2
    with pytest.raises(ValueError):
        hn.scores(np.array([[2**40]]), np.array([[2**40]]))
