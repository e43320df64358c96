"""NOT IN in all its NULL regimes."""

from __future__ import annotations

import pytest
from helpers import values

from claimlink.operators.antijoin import not_in, not_in_every

REGIMES = [
    (["a"], ["b"]),
    (["a", None], []),
    ([], ["a", "b", None]),
    ([None], []),
    (["a", "a", "b"], []),
    (["x"], ["a", "b"]),
]


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "key string, n int")


def ledger(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


def runs(spark, lists):
    return spark.createDataFrame(
        [(run, k) for run, keys in lists.items() for k in keys], "run int, k string"
    )


@pytest.mark.parametrize(("keys", "kept"), REGIMES)
def test_not_in(spark, left, keys, kept):
    found = [r.key for r in not_in(left, "key", ledger(spark, keys)).collect()]
    assert sorted(found, key=str) == sorted(kept, key=str)


def test_not_in_keeps_copies_and_columns(spark):
    left = spark.createDataFrame([("b", 1), ("b", 1), ("a", 1)], "key string, n int")
    result = not_in(left, "key", ledger(spark, ["a"]))
    assert result.columns == ["key", "n"]
    assert values(result, "key", "n") == [("b", 1), ("b", 1)]


def test_struct_keys(spark):
    left = spark.createDataFrame([(("ab", "c"),), (("a", "bc"),)], "key struct<i:string,c:string>")
    listed = spark.createDataFrame([(("ab", "c"),)], "k struct<i:string,c:string>")
    assert values(not_in(left, "key", listed), "key.i") == [("a",)]


def test_each_row_meets_its_own_list(spark):
    left = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), (None, 1)], "key string, run int")
    lists = runs(spark, {1: ["a"], 0: ["b"]})
    assert values(not_in(left, "key", lists, "run", (1, 0)), "key", "run") == [("a", 0)]
    # run 1 has no list at all, so its rows all pass
    lists = runs(spark, {0: ["b"]})
    found = values(not_in(left, "key", lists, "run", (1, 0)), "key", "run")
    assert found == [("a", 0), ("a", 1), (None, 1)]


def test_untested_rows_stay(spark):
    left = spark.createDataFrame(
        [("a", 1, True), ("a", 1, False), (None, 1, False)], "key string, run int, test boolean"
    )
    lists = runs(spark, {1: ["a", None]})
    found = not_in(left, "key", lists, "run", (1,), tested="test")
    assert values(found, "key", "test") == [("a", False), (None, False)]


LISTS = [
    {1: ["a"], 0: ["b"]},
    {1: ["a"], 0: ["a"]},
    {1: ["a", None], 0: ["b"]},
    {1: [None], 0: ["a", None]},
    {1: [], 0: ["a"]},
    {1: ["a", "b"], 0: ["b", "c"]},
    {1: [], 0: []},
]


@pytest.mark.parametrize("lists", LISTS)
def test_not_in_every_is_the_union_of_single_tests(spark, left, lists):
    found = not_in_every(left, "key", runs(spark, lists), "run", (1, 0))
    single = [not_in(left, "key", ledger(spark, keys)) for keys in lists.values()]
    expected = single[0].union(single[1]).distinct()
    assert values(found, "key", "n") == values(expected, "key", "n")
