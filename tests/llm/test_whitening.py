"""Whitening against numpy over the whole table."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import DATA
from pyspark.sql import functions as F

from claimlink.llm import whitening

EMBEDDING = "vec_id long, embedding array<float>, label int"


def usable(vector):
    return vector is not None and all(v is not None and math.isfinite(v) for v in vector)


def expected(rows, components=4, weights="one"):
    """(vec_id, component, n, deviation, |whitened|, explained) by plain numpy."""
    rows = [(i, [math.floor(256 * float(v)) for v in vector]) for i, vector in rows
            if usable(vector)]
    copies = Counter(tuple(x) for _, x in rows)
    lengths = Counter(map(len, copies))
    length = max(lengths, key=lambda k: (lengths[k], k), default=0)
    fit = [list(x) for x, n in copies.items() if len(x) == length
           for _ in range(n if weights == "copies" else 1)]
    if not length:
        return []
    matrix, n = np.array(fit, float), len(fit)
    sums = [sum(x[k] for x in fit) for k in range(length)]
    values, axes = np.linalg.eigh(np.cov(matrix.T, bias=True).reshape(length, length))
    kept = [k for k in np.argsort(-values)[:components] if values[k] > 1e-12 * values.sum()]
    result = []
    for i, x in rows:
        if len(x) == length:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            for number, k in enumerate(kept, 1):
                white = (np.array(x) - np.array(sums) / n) @ axes[:, k] / math.sqrt(values[k])
                result.append((i, number, n, deviation, abs(white), values[k] / values.sum()))
    return result


def check(df, want):
    rows = df.collect()
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained)
                  for r in rows), key=repr)
    want = sorted(want, key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[4])),
                    sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[4])),
                    strict=True):
        assert g[4:] == pytest.approx(w[4:], rel=1e-6, abs=1e-6)
    assert all(abs(r.identity_error) < 1e-9 for r in rows)
    return rows


def pairs(df):
    return [(r.vec_id, r.embedding) for r in df.collect()]


def test_whole_table(session):
    table = session.read.parquet(f"{DATA}/embeddings.parquet")
    rows = check(whitening.whiten(table), expected(pairs(table)))
    assert len(rows) == 4 * table.count()
    by_component = defaultdict(list)
    for r in rows:
        by_component[r.component].append(r.whitened)
    for values in by_component.values():
        assert np.mean(values) == pytest.approx(0, abs=1e-9)
        assert np.var(values) == pytest.approx(1, rel=1e-9)


@pytest.fixture(scope="module")
def odd(session):
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=6).astype(float).tolist() for _ in range(40)]
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    rows += [(100 + i, vectors[0], 1) for i in range(60)]  # a hot vector
    rows += [(3, vectors[3], 0), (3, vectors[3], 0), (None, vectors[5], 0)]
    rows += [(200, None, 0), (201, [], 0), (202, [1.0, 2.0], 0), (203, [None] * 6, 0),
             (204, [math.nan] * 6, 0), (205, [math.inf] + [0.0] * 5, 0), (206, vectors[1], None),
             (207, [-0.0] * 6, 0), (208, [0.0] * 6, 0)]
    df = session.createDataFrame(rows, EMBEDDING)
    return df.selectExpr("*", "'a' AS x", "1 AS weight", "2 AS copies", "3 AS whitened").repartition(5)


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_odd_rows(odd, weights):
    check(whitening.whiten(odd, weights=weights), expected(pairs(odd), weights=weights))


@pytest.mark.parametrize("hot_share", [1, 10, 1000])
def test_hot_vectors_are_joined_whole(odd, monkeypatch, hot_share):
    monkeypatch.setattr(whitening, "HOT_SHARE", hot_share)
    check(whitening.whiten(odd), expected(pairs(odd)))


def test_fewer_dimensions_than_components(session):
    rows = [(i, [float(i), float(i * i % 7)], 0) for i in range(20)]
    df = session.createDataFrame(rows, EMBEDDING)
    assert {r.component for r in check(whitening.whiten(df), expected(pairs(df)))} == {1, 2}


def test_rank_below_the_dimension(session):
    df = session.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 0) for i in range(9)], EMBEDDING)
    assert {r.component for r in check(whitening.whiten(df), expected(pairs(df)))} == {1}


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [], 0)], [(1, [0.5, 1.0], 0)] * 3])
def test_nothing_to_whiten(session, rows):
    result = whitening.whiten(session.createDataFrame(rows, EMBEDDING))
    assert result.collect() == []
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                              "identity_error"]


def test_deviations_beyond_64_bit_sums_are_exact():
    x = np.array([[3_000_000_000, 1], [-5, 7]])
    got = whitening.squared_deviations(x, 2, [2_999_999_995, 8])
    assert got == [3_000_000_005**2 + 36, 3_000_000_005**2 + 36]
    got = whitening.squared_deviations(x, 3, [2_999_999_995, 8])
    assert got == [6_000_000_005**2 + 25, 3_000_000_010**2 + 169]


def test_hot_vectors_are_not_shuffled(odd):
    """The hot vector's rows meet its result by broadcast, the others' by a shuffled key."""
    plan = whitening.whiten(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    assert whitening.whiten(odd).filter(F.col("vec_id") == 100).count() == 4
