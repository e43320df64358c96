"""NOT IN through a Bloom filter: the same rows, fewer of them shuffled."""

from __future__ import annotations

import pytest
from helpers import metric, rows, values
from pyspark.sql import functions as F
from test_antijoin import LISTS, REGIMES

from claimlink.operators import sieve
from claimlink.operators.antijoin import ledger_sieve, not_in
from claimlink.plans import quality
from claimlink.sources import Staging


@pytest.fixture(scope="module")
def staging(spark):
    return Staging(spark)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize(("keys", "kept"), REGIMES)
def test_null_regimes(spark, staging, keys, kept):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "key string, n int")
    ledger = spark.createDataFrame([(k,) for k in keys], "key string")
    found = not_in(left, "key", ledger, sieve=ledger_sieve(ledger, staging))
    assert sorted((r.key for r in found.collect()), key=str) == sorted(kept, key=str)


@pytest.mark.parametrize("lists", LISTS)
def test_lists_of_several_runs(spark, staging, lists):
    left = spark.createDataFrame(
        [(k, run, tested, n) for n, k in enumerate(["a", "b", "c", None]) for run in (1, 0)
         for tested in (True, False)],
        "key string, run int, tested boolean, n int",
    )
    ledger = spark.createDataFrame(
        [(run, k) for run, keys in lists.items() for k in keys], "run int, key string"
    )
    for tested in (None, "tested"):
        plain = not_in(left, "key", ledger, "run", (1, 0), tested)
        through = not_in(
            left, "key", ledger, "run", (1, 0), tested, ledger_sieve(ledger, staging)
        )
        assert through.columns == plain.columns
        assert rows(through) == rows(plain)


def test_struct_keys_and_copies(spark, staging):
    schema = "key struct<i:string,c:string>"
    left = spark.createDataFrame([(("ab", "c"),), (("a", "bc"),), (("a", "bc"),)], schema)
    ledger = spark.createDataFrame([(("ab", "c"),), (("ab", "c"),)], schema)
    found = not_in(left, "key", ledger, sieve=ledger_sieve(ledger, staging))
    assert values(found, "key.i") == [("a",), ("a",)]


def keyed(spark, n, offset=0):
    return spark.range(offset, offset + n).select(
        F.concat(F.lit("claim-"), F.col("id").cast("string")).alias("key")
    )


def test_no_listed_key_is_ever_missed_and_few_others_pass(spark, staging):
    listed = staging(keyed(spark, 20_000), "listed")
    found = sieve.sieve_of(listed, staging)
    assert found.maybe(listed, ["key"]).count() == 20_000
    assert found.surely_not(listed, ["key"]).count() == 0
    others = keyed(spark, 100_000, offset=1_000_000)
    passed = found.maybe(others, ["key"]).count()
    assert passed + found.surely_not(others, ["key"]).count() == 100_000
    assert 0 < found.false_positives() < 0.01
    assert 0.5 < passed / (100_000 * found.false_positives()) < 2


def test_fewer_bits_let_more_pass(spark, staging):
    """At the least number of bits the estimate still holds, and results stay right."""
    n = 20_000
    listed = staging(keyed(spark, n), "listed")
    limit = n * sieve.LEAST_BITS // 256 * 48 + 48
    small = sieve.sieve_of(listed, staging, limit)
    others = keyed(spark, 50_000, offset=1_000_000)
    passed = small.maybe(others, ["key"]).count() / 50_000
    assert passed > 0.05
    assert 0.8 < passed / small.false_positives() < 1.25
    left = listed.union(others)
    assert not_in(left, "key", listed, sieve=small).count() == 50_000


def test_a_list_too_long_gets_no_sieve(spark, staging):
    listed = staging(keyed(spark, 5_000), "listed")
    assert ledger_sieve(listed, staging, 48) is None
    assert not_in(listed, "key", listed, sieve=None).count() == 0
    assert sieve.blocks_for(10**12) is None
    for keys in (0, 1, 10**6, 7 * 10**7):
        assert sieve.blocks_for(keys) * 48 <= sieve.MAX_BYTES


def test_the_filter_is_bounded(spark, staging):
    """One row per block, whatever the list holds."""
    hot = spark.range(50_000).select(F.lit("same").alias("key"))
    found = ledger_sieve(hot, staging)
    assert found.words.count() == 1
    assert found.words.columns == ["_sieve_block", *[f"_sieve_{k}" for k in range(4)]]


@pytest.mark.parametrize("listed_share", [0.0, 0.01, 0.1, 0.5])
def test_only_rows_that_may_be_listed_are_shuffled(spark, staging, no_broadcast, listed_share):
    n = 20_000
    left = staging(
        spark.range(n).select(
            F.concat(F.lit("claim-"), F.col("id").cast("string")).alias("key"),
            F.lit("x" * 50).alias("payload"),
        ),
        "left",
    )
    step = round(1 / listed_share) if listed_share else n + 1
    ledger = staging(left.filter(F.expr(f"(crc32(key) % {step}) = 1")).select("key"), "ledger")
    listed = ledger.count()
    plain, through = not_in(left, "key", ledger), not_in(
        left, "key", ledger, sieve=ledger_sieve(ledger, staging)
    )
    assert len(plain.collect()) == len(through.collect()) == n - listed
    before = sum(metric(plain, "ShuffleExchangeExec", "dataSize"))
    after = sum(metric(through, "ShuffleExchangeExec", "dataSize"))
    rows_before = sum(metric(plain, "ShuffleExchangeExec", "shuffleRecordsWritten"))
    rows_after = sum(metric(through, "ShuffleExchangeExec", "shuffleRecordsWritten"))
    assert rows_before >= n
    # the ledger's own two shuffles stay, and a state row per task
    assert rows_after - (rows_before - n) <= listed + 0.02 * n
    assert after <= before - 0.9 * (n - listed) * 80


def encounters(spark, n, repeated):
    """``n`` combinations, every ``repeated``-th of them three times, and two with NULL parts."""
    i = F.col("id")
    rows = spark.range(n).select(
        F.concat(F.lit("encounter-"), F.col("id")).alias("encounter_key"),
        F.concat(F.lit("C"), i % 7).alias("codes"),
        F.explode(F.sequence(F.lit(1), F.when(i % repeated == 0, 3).otherwise(1))).alias("copy"),
    )
    null = spark.createDataFrame(
        [(None, "C1", 1), (None, "C1", 2), ("e", None, 1), (None, None, 1)],
        "encounter_key string, codes string, copy int",
    )
    return rows.union(null)


@pytest.mark.parametrize("repeated", [2, 50, 10**9])
def test_duplicates_through_a_sieve_are_the_same(spark, staging, repeated, monkeypatch):
    final = staging(encounters(spark, 5_000, repeated), "final")
    plain = quality.duplicates(final)
    assert rows(quality.duplicates(final, staging)) == rows(plain)
    monkeypatch.setattr(quality, "sieve_of", lambda *_: None)
    assert rows(quality.duplicates(final, staging)) == rows(plain)


def test_few_duplicates_shuffle_few_keys(spark, staging, no_broadcast):
    """What is counted first is eight bytes a row; keys are shuffled for the repeated ones only."""
    final = staging(encounters(spark, 20_000, 200), "final")
    plain, through = quality.duplicates(final), quality.duplicates(final, staging)
    assert len(plain.collect()) == len(through.collect()) == 101
    (before,) = metric(plain, "ShuffleExchangeExec", "shuffleRecordsWritten")
    (after,) = metric(through, "ShuffleExchangeExec", "shuffleRecordsWritten")
    assert before >= 20_000 and after < 1_000
