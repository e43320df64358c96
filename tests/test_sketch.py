"""Invertible sketches: planted differences are named, equal rows in any order are not."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from helpers import metric, plan_nodes, rows
from pyspark.sql import functions as F

from claimlink.operators import sketch
from claimlink.plans import quality
from claimlink.sources import Staging

KEY = ["key"]


@pytest.fixture(scope="module")
def staging(spark):
    return Staging(spark)


def keyed(spark, n, offset=0):
    return spark.range(offset, offset + n).select(F.concat(F.lit("claim-"), "id").alias("key"))


def listed(df):
    return sorted(((*r,) for r in df.collect()), key=str)


def test_equal_tables_have_no_differences(spark):
    a = keyed(spark, 20_000)
    b = a.repartition(7).orderBy(F.rand(3))
    assert sketch.cells_of(a, b, KEY, 64).count() == 0
    assert listed(sketch.differing(a, b, KEY)) == []


def test_planted_differences_are_named_with_their_counts(spark, staging):
    a = staging(keyed(spark, 30_000), "a")
    gone = F.col("key").isin("claim-5", "claim-29999")
    more = spark.createDataFrame([("claim-7",)] * 3 + [("new",)] * 2 + [(None,)], "key string")
    b = staging(a.filter(~gone).unionAll(more), "b")
    assert listed(sketch.differing(a, b, KEY)) == [
        ("claim-29999", 1, 0), ("claim-5", 1, 0), ("claim-7", 1, 4), ("new", 0, 2), (None, 0, 1),
    ]


def test_only_rows_of_differing_keys_are_shuffled(spark, staging):
    a = staging(keyed(spark, 50_000), "a")
    b = staging(a.filter("key <> 'claim-17'"), "b")
    cells = sketch.cells_of(a, b, KEY, 16)
    assert cells.collect()
    tasks = a.rdd.getNumPartitions() + b.rdd.getNumPartitions()
    assert sum(metric(cells, "ShuffleExchangeExec", "shuffleRecordsWritten")) <= 48 * tasks
    found = sketch.differing(a, b, KEY)
    assert listed(found) == [("claim-17", 1, 0)]
    assert sum(metric(found, "ShuffleExchangeExec", "shuffleRecordsWritten")) == 1


def test_what_the_cells_cannot_tell_apart_is_counted(spark, staging):
    """More differences than cells: the plain count gives the same rows."""
    a = staging(keyed(spark, 3_000), "a")
    b = staging(keyed(spark, 3_000, offset=1_000).unionAll(keyed(spark, 40)), "b")
    assert sketch.peel(sketch.cells_of(a, b, KEY, 16).collect(), 16) is None
    found = sketch.differing(a, b, KEY, cells=16)
    assert "BroadcastHashJoinExec" not in {n.getClass().getSimpleName() for n in plan_nodes(found)}
    assert listed(found) == listed(sketch.differing(a, b, KEY))
    assert found.count() == 1_960


@pytest.mark.parametrize("cells", [1, 2, 64, 4096])
def test_random_tables(spark, cells):
    """Against counters: several columns, NULLs in either place, repeats on both sides."""
    rng = random.Random(cells)
    words = [None, "", "a", "b", "ab"]
    table = [(rng.choice(words), rng.choice([None, *range(30)])) for _ in range(600)]
    other = [r for r in table if rng.random() > 0.05] + rng.choices(table, k=20)
    schema = "x string, y int"
    a, b = spark.createDataFrame(table, schema), spark.createDataFrame(other, schema)
    x, y = Counter(table), Counter(other)
    want = sorted(((*k, x[k], y[k]) for k in x | y if x[k] != y[k]), key=str)
    assert listed(sketch.differing(a, b, ["x", "y"], cells)) == want
    assert rows(sketch.differing(b, a, ["x", "y"], cells).select("x", "y")) == rows(
        sketch.differing(a, b, ["x", "y"], cells).select("x", "y")
    )


def test_a_hot_key_and_empty_tables(spark):
    hot = spark.range(100_000).select(F.lit("same").alias("key"))
    less = hot.limit(99_999)
    none = hot.limit(0)
    assert listed(sketch.differing(hot, less, KEY)) == [("same", 100_000, 99_999)]
    assert listed(sketch.differing(hot, none, KEY)) == [("same", 100_000, 0)]
    assert listed(sketch.differing(none, none, KEY)) == []


def test_sums_of_very_many_rows_fit(spark):
    """The largest part of a digest, added up for two million million rows."""
    assert (2 * sketch._PART + 1) * 2 * 10**12 < 2**63
    assert max(sketch._parts(-1)) == 2 * sketch._PART + 1
    d = -(1 << 63) + 12345
    p0, p1, p2 = sketch._parts(d)
    assert (p0 << 42 | p1 << 21 | p2) - (1 << 64) == d


def test_claims_lost_and_multiplied_between_steps(claims):
    before = claims(*[{"claim_id": f"c{n}"} for n in range(5)])
    after = claims(*[{"claim_id": c} for c in ("c0", "c1", "c1", "c3", "c9")])
    assert listed(quality.reconcile_rows(before, after)) == [
        ("c1", 1, 2), ("c2", 1, 0), ("c4", 1, 0), ("c9", 0, 1),
    ]
