"""Claims told by hashes before whole claims are shuffled."""

from __future__ import annotations

import pytest
from helpers import metric, plan_nodes, rows
from pyspark.sql import functions as F

import __spark_entry__ as driver
from claimlink.operators.base import enrich_tokens, segment, standardize
from claimlink.operators.link import linked_claims
from claimlink.operators.match import best_matches
from claimlink.operators.near import near, near_sides
from claimlink.plans import integrate as plan
from claimlink.plans import quality
from claimlink.plans.integrate import distinct_rows
from claimlink.schema import CLAIM_COLUMNS, DEFAULT_RULES, EXACT_KEYS, LINK_KEYS
from claimlink.sources import Staging
from claimlink.sources.fixture import inputs

DATA = "/root/testdata/sf0.001"


def sides():
    return F.col("datasource") == "A", F.col("datasource") == "B"


@pytest.fixture(scope="module")
def base(spark):
    return Staging(spark)(inputs(spark, DATA).all_claims(), "base")


@pytest.mark.parametrize("tolerance", [0, 1, 5])
def test_days_in_reach_share_a_band(spark, claims, tolerance):
    """Every start of the bands, every distance within reach."""
    table = claims(*[
        {"datasource": side, "patient_token_1": f"{start}/{gap}", "dos": start + (gap if side == "B" else 0)}
        for start in range(12) for gap in range(-tolerance, tolerance + 1) for side in "AB"
    ])
    kept = near(table, ["patient_token_1"], *sides(), tolerance, Staging(spark))
    assert kept.count() == table.count()


def test_most_unlinked_claims_stay_where_they_are(spark, base):
    claims = Staging(spark)(plan.run_claims(base, (1, 0), DEFAULT_RULES), "claims")
    keys = plan._RUN_KEYS
    kept = near(claims, keys, *sides(), 5, Staging(spark))
    assert kept.count() < claims.count() / 2
    linked = linked_claims(claims, keys).select(*CLAIM_COLUMNS)
    assert linked.exceptAll(kept.select(*CLAIM_COLUMNS)).isEmpty()
    assert near(claims, keys, *sides(), 5, Staging(spark), max_bytes=1).count() == claims.count()


@pytest.mark.parametrize("options", [
    {}, {"exclude": "winners"}, {"leftovers": "own_flag"}, {"purged": False, "key_mode": "struct"},
])
def test_sieves_do_not_change_the_result(spark, base, options):
    """Against the plain joins of a session without broadcasts; with rows that occur twice."""
    table = Staging(spark)(base.union(base.filter("claim_id LIKE '%1'")), "twice")
    sieved = rows(plan.integrate(table, (1, 0), **options))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert rows(plan.integrate(table, (1, 0), **options)) == sieved
    finally:
        spark.conf.set(key, before)


def test_null_claim_ids_pass_by_the_rules_of_not_in(spark, base, claims):
    """A used key that is NULL blocks its run; rows without a key come back from an empty list only."""
    pair = [{"datasource": v, "claim_id": None, "paid_flag": 1} for v in "AB"]
    table = claims(*pair, {"claim_id": "x", "dos": 300}, {"claim_id": None, "dos": 400})
    assert plan.integrate(table, (1,)).filter("data_source <> 'Both'").isEmpty()
    assert plan.integrate(table, (1, 0)).filter("data_source <> 'Both'").count() == 4


def test_only_doubtful_rows_are_shuffled_for_the_distinct(spark, base):
    staging = Staging(spark)
    run = plan.integrate_run(base, (1, 0), staging=staging)
    rows = base.select(*CLAIM_COLUMNS, F.concat("claim_id", "code").alias("claim_key"))
    settled, doubtful = plan._settled(rows, run.used, staging)
    assert settled.count() + doubtful.count() == base.count()
    assert doubtful.count() < base.count() / 2
    assert settled.distinct().count() == settled.count()
    keys = run.used.select("claim_key")
    assert settled.join(keys, "claim_key", "left_semi").isEmpty()


def test_bridge_goes_to_the_claims_by_its_measured_size(spark):
    i = inputs(spark, DATA)
    claims = standardize(i.treatment, "treatment")

    def physical(df):
        return df._jdf.queryExecution().executedPlan().toString()

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")  # below any table: what is broadcast is so by its hint
    try:
        assert "BroadcastHashJoin [original_token_1" in physical(enrich_tokens(claims, i.bridge))
        large = physical(enrich_tokens(claims, i.bridge, broadcast_bytes=10))
        assert "SortMergeJoin [original_token_1" in large
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("keys", [LINK_KEYS, EXACT_KEYS])
def test_sides_of_a_scenario_shrink_before_they_are_shuffled(spark, base, keys):
    anchor = keys is LINK_KEYS
    a, b = (segment(v, anchor, base).filter("paid_flag = 1") for v in "AB")
    own, other = near_sides(a, b, keys, 5, Staging(spark))
    assert own.count() + other.count() < (a.count() + b.count()) / 2
    assert rows(best_matches(own, other, keys, ranks=True)) == rows(
        best_matches(a, b, keys, ranks=True)
    )


def test_distinct_shuffles_only_rows_that_may_repeat(spark, base):
    twice = base.union(base.filter("claim_id LIKE '%1'"))
    kept = distinct_rows(twice, Staging(spark))
    assert rows(kept) == rows(twice.distinct())
    kept.collect()
    (doubtful, *_) = sorted(metric(kept, "ShuffleExchangeExec", "shuffleRecordsWritten"))
    assert doubtful < base.count() / 2


@pytest.mark.parametrize("purged", [True, False])
def test_rows_of_both_runs_are_not_shuffled_for_the_union(spark, base, purged):
    """UNION of two tables that share most rows: the same rows, only doubtful ones in its DISTINCT."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    tables = [plan.integrate(base, (flag,), purged=purged) for flag in (1, 0)]
    plain, merged = plan.merge_final(*tables), plan.merge_runs(base, purged=purged)
    assert rows(merged) == rows(plain)
    before, after = (
        sum(metric(df, "ShuffleExchangeExec", "shuffleRecordsWritten"))
        for df in (plain, merged)
        if df.collect()
    )
    assert after < before / 2
    kept = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert rows(plan.merge_runs(base, purged=purged)) == rows(plain)
    finally:
        spark.conf.set(key, kept)


@pytest.mark.parametrize("null_flag", [1, 0])
def test_union_of_runs_when_a_used_key_is_null(claims, null_flag):
    """One run is blocked by its NULL key; the other still lists all claims but those it used."""
    table = claims(
        *({"datasource": v, "claim_id": None, "paid_flag": null_flag} for v in "AB"),
        *({"datasource": v, "claim_id": "u", "paid_flag": 1 - null_flag, "dos": 200} for v in "AB"),
        {"claim_id": "x", "dos": 300},
        {"claim_id": "x", "dos": 300},
        {"claim_id": None, "dos": 400},
    )
    for flags in ((1, 0), (0, 1)):
        plain = plan.merge_final(*(plan.integrate(table, (f,)) for f in flags))
        assert rows(plan.merge_runs(table)) == rows(plain)


def test_rows_alike_in_what_is_hashed_only_stay_apart(spark, claims):
    """Rows are counted by a hash of some columns: copies are one row, others all stay."""
    base = Staging(spark)(
        claims(
            *[{"claim_id": "same", "source": s} for s in ("x", "y", "y", "z", "z", "z")],
            *[{"claim_id": f"c{k}"} for k in range(50)],
        ),
        "base",
    )
    result = plan.integrate(base, (1,), staging=Staging(spark))
    assert result.count() == 3 + 50
    assert rows(result) == rows(result.distinct())


def test_only_telling_columns_are_read_to_count_rows(spark, claims, monkeypatch):
    base = Staging(spark)(claims(*[{"claim_id": f"c{k}"} for k in range(5)]), "base")
    seen = []
    monkeypatch.setattr(plan, "_repeated", lambda digests, staging: seen.append(digests))
    keyed = base.select("*", plan.claim_key().alias("claim_key"))
    assert plan._settled(keyed, keyed.select("claim_key"), Staging(spark)) is None
    (scan,) = [n for n in plan_nodes(seen[0]) if n.getClass().getSimpleName() == "FileSourceScanExec"]
    read = set(scan.requiredSchema().fieldNames())
    assert read == set(plan._TELLING) and "source" not in read


def test_the_report_stores_its_profile_without_a_shuffle(spark, base):
    profile = quality._profile(Staging(spark)(plan.integrate(base, (1,)), "final"))
    profile.collect()
    assert not [n for n in plan_nodes(profile) if "Exchange" in n.getClass().getSimpleName()]


def test_repeated_encounters_store_their_keys_only(spark, monkeypatch):
    stored, call = {}, Staging.__call__

    def store(self, df, name):
        stored[name] = df.columns
        return call(self, df, name)

    monkeypatch.setattr(Staging, "__call__", store)
    driver._QUERIES["duplicate_encounters"](spark, DATA)
    assert stored["encounters"] == ["encounter_key", "codes"] and "final" not in stored
