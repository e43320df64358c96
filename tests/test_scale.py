"""Plans and hot groups."""

from __future__ import annotations

import re

import pytest
from helpers import values
from pyspark.sql import functions as F

from claimlink.operators.antijoin import not_in, not_in_every
from claimlink.operators.base import enrich_codes, enrich_tokens, segment, standardize
from claimlink.operators.link import (
    band_join,
    crowded_keys,
    hot_bands,
    link,
    linked_claims,
    linked_days,
    other_side,
    pairs_in_reach,
)
from claimlink.operators.match import (
    best_alternatives,
    best_matches,
    best_of,
    met_days,
    vendor_rows,
)
from claimlink.operators.rank import place_in_ranges, rank_links
from claimlink.operators.sweep import sweep
from claimlink.plans import integrate as plan
from claimlink.plans import quality, scenarios
from claimlink.schema import (
    BRIDGE_SCHEMA,
    CLAIM_COLUMNS,
    CLAIM_SCHEMA,
    DEFAULT_RULES,
    EXACT_KEYS,
    FILL_ATTRIBUTES,
    LINK_KEYS,
    OTHER_COLUMNS,
)
from claimlink.session import configure
from claimlink.sources import Staging, conform
from claimlink.sources.fixture import inputs

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base(spark):
    return Staging(spark)(inputs(spark, DATA).all_claims(), "base")


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_tables_are_never_broadcast(base, no_broadcast):
    staging = Staging(base.sparkSession)
    a, b = segment("A", True, base), segment("B", True, base)
    for df in (
        plan.integrate(base, (1, 0), staging=staging),
        plan.integrate(base, (1,), exclude="winners", staging=staging),
        scenarios.scenario_1(a, b, exclude="winners"),
        scenarios.ranked_pass_2(a, b, exclude="winners"),
    ):
        text = physical(df)
        assert not re.search(r"Broadcast\w*Join|CartesianProduct", text)


def test_not_in_costs_no_second_shuffle_for_the_distinct(base, no_broadcast):
    used = base.limit(10).select("paid_flag", F.concat("claim_id", "code").alias("claim_key"))
    used = Staging(base.sparkSession)(used, "used")
    rest = plan._rest(base, used, (1, 0), "all", True, "concat", DEFAULT_RULES)
    main = physical(rest)
    shuffled = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", main)
    by_rows = [keys for keys in shuffled if "patient_id" in keys]
    by_key = [keys for keys in shuffled if re.fullmatch(r"claim_key#\d+", keys)]
    assert (len(by_rows), len(by_key)) == (0, 1)


def test_scans_are_pruned_and_filtered(base):
    runs = plan.run_claims(base, (1,), DEFAULT_RULES)
    text = physical(linked_days(runs, plan._RUN_KEYS))
    (schema,) = set(re.findall(r"ReadSchema: struct<(.*)>", text))
    assert "days_supply" not in schema
    assert "claim_id" not in schema
    assert "IsNotNull(patient_token_1)" in text
    assert "EqualTo(paid_flag,1)" in text or "In(paid_flag" in text


def test_the_bridge_is_joined_once(spark, no_broadcast):
    i = inputs(spark, DATA)
    text = physical(i.all_claims())
    assert len(re.findall(r"SortMergeJoin \[original_token_1", text)) == 1


def test_five_ranks_take_one_sort_of_the_pairs(base):
    a, b = segment("A", True, base), segment("B", True, base)
    text = physical(rank_links(a, b))
    windows = re.findall(r"\bWindow \[.*?windowspecdefinition\((\w+)#", text)
    assert windows.count("patient_token_1") == 1  # the sweep over both sides, before the pairs
    assert 1 <= windows.count("patient_token_2") <= 2  # along the order, and over the whole group
    assert len(re.findall(r"Sort \[patient_token_2", text)) == 1


def test_partitions_grow_with_the_input(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"]
    before = [spark.conf.get(n) for n in names]
    try:
        configure(spark, input_bytes=1)
        assert spark.conf.get(names[0]) == before[0]
        configure(spark, input_bytes=100 * 1024**4)
        partitions, split = (int(spark.conf.get(n)) for n in names)
        assert 50_000 < partitions < 65_000
        assert partitions * split >= 100 * 1024**4
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)


def test_what_a_task_reads_stays_bounded(spark):
    """Stored claims are many times as large as rows: larger sizes of the session are cut to 16 MB."""
    names = [
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.shuffle.partitions",
    ]
    before = [spark.conf.get(n) for n in names]
    try:
        for given, kept in (("128m", 16 * 1024**2), ("64m", 16 * 1024**2), ("1048576", 1024**2)):
            for name in names[:2]:
                spark.conf.set(name, given)
            configure(spark, input_bytes=6 * 1024**3)
            assert [int(spark.conf.get(n)) for n in names[:2]] == [kept, kept]
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)


SIZE = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """Two thirds of the claims are one patient's, one code's and one day's."""
    n = F.col("id")
    hot_row = n < 2 * SIZE
    vendor = F.when(n % 2 == 0, F.lit("A")).otherwise(F.lit("B"))
    columns = {
        "datasource": vendor,
        "claim_id": F.concat(vendor, F.lpad(n.cast("string"), 8, "0")),
        "patient_token_1": F.when(hot_row, F.lit("t")).otherwise(F.concat(F.lit("t"), n / 2)),
        "patient_token_2": F.when(hot_row, F.lit("t")).otherwise(F.concat(F.lit("t"), n / 2)),
        "dos": F.to_date(F.lit("2020-01-01")),
        "code": F.lit("c"),
        "code_group1": F.lit("g"),
        "provider_id": F.when(n == 2 * SIZE - 1, F.lit("last")),
        "paid_flag": F.lit(1),
    }
    rows = spark.range(3 * SIZE).select(
        *[columns.get(c, F.lit(None)).alias(c) for c in CLAIM_COLUMNS]
    )
    return Staging(spark)(conform(rows, CLAIM_SCHEMA), "hot")


def test_a_hot_group_is_integrated_without_its_pairs(hot):
    """900 million pairs; the result has one of them, and the right fill from another."""
    result = plan.integrate(hot, (1,))
    both = result.filter("data_source = 'Both'")
    assert values(both, "encounter_key", "provider_id") == [("A00000000", "last")]
    # odd and even numbers beyond the hot group never share a token
    assert result.count() == SIZE + 1


def test_ranks_of_a_hot_group_count_pairs_that_are_not_listed(hot):
    a, b = segment("A", True, hot), segment("B", True, hot)
    row = scenarios.scenario_1(a, b).first()
    assert (row.claim_id, row.other_claim_id) == ("A00000000", "B00000001")
    # each of the group's claims has a pair with the one partner that has a provider
    assert (row.rn, row.rn_other_provider_id, row.rn_other_days_supply) == (1, SIZE + 1, 1)


def test_hot_key_among_unlinked_claims(hot, claims):
    """Half of the claims share one id and code; copies and NULL keys included."""
    base = hot.withColumn(
        "claim_id",
        F.when(F.col("patient_token_1") == "t", F.lit("same"))
        .when(F.col("datasource") == "A", F.col("claim_id")),
    ).withColumn("patient_token_1", F.lit(None).cast("string"))
    result = plan.integrate(base, (1,), purged=False)
    assert result.count() == base.select(*CLAIM_COLUMNS).distinct().count()
    assert LINK_KEYS[0] in result.columns


@pytest.fixture
def small_skew(no_broadcast, spark):
    """Skew handling at the size of test data."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def splits_skew(df, join: str) -> bool:
    """Whether the executed plan split a skewed join of that kind."""
    df.write.format("noop").mode("overwrite").save()
    df = df.select("*")
    df.collect()
    text = physical(df).split("== Initial Plan ==")[0]
    return any("skew=true" in line and join in line for line in text.splitlines())


def test_hot_keys_are_split_in_not_in(spark, hot, small_skew):
    rows = hot.withColumn(
        "claim_key", F.when(F.col("patient_token_1") == "t", "hot").otherwise(F.col("claim_id"))
    )
    listed = rows.filter("claim_key <> 'hot' AND claim_key LIKE '%7'").select("claim_key")
    assert splits_skew(not_in(rows, "claim_key", listed), "LeftAnti")
    lists = listed.select(F.explode(F.array(F.lit(1), F.lit(0))).alias("run"), "claim_key")
    rest = not_in_every(rows, "claim_key", lists, "run", (1, 0))
    assert splits_skew(rest, "LeftAnti")
    assert splits_skew(rest.distinct(), "LeftAnti")


def test_hot_keys_are_split_when_linked_claims_are_picked(hot, small_skew):
    assert splits_skew(linked_claims(hot, LINK_KEYS), "LeftSemi")


def test_claims_without_tokens_are_split_in_the_bridge_join(spark, hot, small_skew):
    token = F.when(F.col("patient_token_1") != "t", F.col("patient_token_1"))
    claims = hot.withColumns({"original_token_1": token, "original_token_2": token}).drop(
        "patient_token_1", "patient_token_2"
    )
    bridge = spark.range(10).select(
        *[F.concat(F.lit(c), "id").alias(c) for c in BRIDGE_SCHEMA.fieldNames()]
    )
    assert splits_skew(enrich_tokens(claims, bridge), "LeftOuter")


def alike(hot, size, ids=lambda n: n):
    """Claims of both vendors in one group, ids from ``ids``."""
    own, other = (
        segment(v, True, hot).filter("patient_token_1 = 't'").limit(size) for v in ("A", "B")
    )
    return own.withColumn("claim_id", ids(F.col("claim_id"))), other


@pytest.mark.parametrize(
    "ids",
    [
        lambda c: c,
        lambda c: F.when(c == F.lit("A00000000"), F.lit("0")).otherwise(c),  # one odd id
        lambda c: F.lit("same"),
    ],
)
def test_ranks_of_a_hot_group_are_shared_by_tasks(spark, hot, ids):
    size = 300
    own, other = alike(hot, size, ids)
    own = own.withColumn("provider_id", F.concat(F.lit("p"), F.expr("uuid()")))
    staging = Staging(spark)
    own, other = staging(own, "own"), staging(other, "other")
    placed = place_in_ranges(
        band_join(own, other_side(other, LINK_KEYS), LINK_KEYS, 5), staging
    )
    shares = [r["count"] for r in placed.groupBy("_range").count().collect()]
    assert sum(shares) == size * size
    assert max(shares) < 0.5 * sum(shares)
    columns = ["claim_id", "other_claim_id", "provider_id", "rn", "rn_other_days_supply"]
    whole = values(rank_links(own, other), *columns)
    assert values(rank_links(own, other, hot_pairs=10), *columns) == whole
    assert sorted(r[3] for r in whole) == list(range(1, size * size + 1))


def test_pairs_of_a_hot_day_are_made_by_many_tasks(spark, hot, no_broadcast):
    size = 4000
    own, other = alike(hot, size)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shares = (
            link(own, other).select("claim_id").groupBy(F.spark_partition_id()).count().collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(r["count"] for r in shares) == size * size
    assert len(shares) > 1 and max(r["count"] for r in shares) < 0.8 * size * size


def test_cells_do_not_change_pairs(spark, hot):
    own, other = alike(hot, 50)
    other = other_side(other, LINK_KEYS)
    staging = Staging(spark)
    for side in (3, 7, 49):
        cells = hot_bands(own, other, LINK_KEYS, 5, staging, side)
        assert cells is not None
        pairs = band_join(own, other, LINK_KEYS, 5, cells)
        ids = pairs.select("claim_id", "other_claim_id")
        assert ids.count() == ids.distinct().count() == 2500
    assert hot_bands(own, other, LINK_KEYS, 5, staging, 50) is None


def test_best_rows_form_no_pair_table(base):
    a, b = segment("A", True, base), segment("B", True, base)
    for df in (best_matches(a, b, attributes=[]), best_alternatives(a, b, "days_supply")):
        text = physical(df)
        # the one window is the sweep over days; no row of it is a pair
        assert len(re.findall(r"\bWindow \[", text)) == text.count("RangeFrame, -5, 5") == 1
        # both sides are one row per key and day before they meet
        below = text[text.index("Window ["):]
        assert len(re.findall(r"Aggregate\(key=\[patient_token_1\S+ patient_token_2\S+ code\S+ _day",
                              below)) >= 2
        assert not re.search(r"Join|Expand", text)


def test_code_reference_is_broadcast_by_its_measured_size(spark, no_broadcast):
    i = inputs(spark, DATA)
    claims = standardize(i.treatment, "treatment")
    assert "BroadcastHashJoin [code" in physical(enrich_codes(claims, i.codes))
    large = physical(enrich_codes(claims, i.codes, broadcast_bytes=10))
    assert "SortMergeJoin [code" in large and "Broadcast" not in large


def test_final_table_is_scanned_once_by_the_report(spark, base):
    staging = Staging(spark)
    final = staging(plan.integrate(base, (1,), staging=staging), "final")
    report = quality.quality_report(base, base, final, staging=staging)
    text = physical(report)
    assert "-final" not in text and text.count("-profile") > 0


def test_stored_steps_can_be_dropped(spark, base):
    staging = Staging(spark)
    stored = staging(base.limit(3), "few")
    assert stored.count() == 3
    staging.drop()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{staging.folder}/000-few")


def test_steps_need_a_named_folder():
    class Nameless:
        conf = {}
        sparkContext = type("Context", (), {"getCheckpointDir": lambda self: None})()

    with pytest.raises(ValueError):
        Staging(Nameless())


def crowd(spark, days, size):
    """Claims of one patient and code: ``size`` of the primary vendor on the first day, ``size`` of
    the secondary one so many days later."""
    primary = F.col("id") % 2 == 0
    columns = {
        "datasource": F.when(primary, F.lit("A")).otherwise(F.lit("B")),
        "claim_id": F.concat(F.lit("c"), F.col("id")),
        "patient_token_1": F.lit("t"),
        "patient_token_2": F.lit("t"),
        "dos": F.date_add(F.to_date(F.lit("2020-01-01")), F.when(primary, 0).otherwise(days)),
        "code": F.lit("c"),
        "code_group1": F.lit("g"),
        "paid_flag": F.lit(1),
    }
    rows = spark.range(2 * size).select(
        *[columns.get(c, F.lit(None)).alias(c) for c in CLAIM_COLUMNS]
    )
    return Staging(spark)(conform(rows, CLAIM_SCHEMA), "crowd")


def test_a_sweep_copies_no_side(base, no_broadcast):
    """One shuffle of both sides, no join and no copies into neighbouring bands."""
    own = segment("A", True, base)
    other = other_side(segment("B", True, base), LINK_KEYS)
    text = physical(sweep(own, other, LINK_KEYS, 5))
    assert not re.search(r"Join|Expand|explode\(array", text)
    assert len(re.findall("Exchange hashpartitioning", text)) == 1
    joined = physical(band_join(own, other, LINK_KEYS, 5))
    assert len(re.findall("Exchange hashpartitioning", joined)) == 2 and "Join" in joined


def test_a_sweep_makes_the_pairs_of_a_band_join(base):
    own = segment("A", True, base)
    other = other_side(segment("B", True, base), LINK_KEYS)
    for tolerance in (0, 1, 5, 40):
        swept, joined = (
            f(own, other, LINK_KEYS, tolerance) for f in (sweep, band_join)
        )
        assert swept.columns == [*own.columns, *[c for c in OTHER_COLUMNS], "abs_date_diff"]
        assert values(swept, *joined.columns) == values(joined, *joined.columns)


def test_days_out_of_reach_are_not_compared(spark):
    """Neighbouring bands, but nine days apart: n times n comparisons would not end in time."""
    claims = crowd(spark, 9, 40_000)
    a, b = segment("A", True, claims), segment("B", True, claims)
    assert rank_links(a, b).count() == 0
    assert link(a, b).count() == 0
    assert best_matches(a, b).count() == 0


@pytest.mark.parametrize("distinct", [True, False])
def test_equal_claims_are_spread_over_cells(spark, distinct):
    """Pairs of repeated rows are made by many tasks, and none is lost."""
    size = 2500
    claims = crowd(spark, 3, size).withColumn("claim_id", F.lit("same"))
    a, b = Staging(spark)(segment("A", True, claims), "a"), segment("B", True, claims)
    pairs = link(a, b, distinct=distinct)
    assert pairs.count() == (1 if distinct else size * size)
    if not distinct:
        before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            tasks = link(a, b, distinct=False).groupBy(F.spark_partition_id()).count().collect()
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        assert len(tasks) > 1 and max(r["count"] for r in tasks) < 0.8 * size * size


def test_crowded_keys_and_others_give_the_pairs_of_one_join(base):
    """Whatever counts as crowded."""
    staging = Staging(base.sparkSession)
    own = segment("A", True, base)
    other = other_side(segment("B", True, base), LINK_KEYS)
    want = values(band_join(own, other, LINK_KEYS, 5), "claim_id", "other_claim_id", "dos")
    for side in (1, 2, 1000):
        crowded = crowded_keys(own, other, LINK_KEYS, 5, staging, side)
        assert (crowded is None) == (side == 1000)
        pairs = pairs_in_reach(own, other, LINK_KEYS, 5, staging, crowded, side)
        assert values(pairs, "claim_id", "other_claim_id", "dos") == want


def test_integration_shuffles_the_link_keys_twice(base, no_broadcast):
    """Days are counted and swept once; linked days and winners come from the stored outcome."""
    claims = plan.run_claims(base, (1, 0), DEFAULT_RULES)
    days = met_days(vendor_rows(claims, plan._RUN_KEYS), plan._RUN_KEYS, FILL_ATTRIBUTES, 5)
    assert len(re.findall("Exchange hashpartitioning", physical(days))) == 2
    run = plan.integrate_run(base, (1, 0))
    best = physical(best_of(run.met, plan._RUN_KEYS, group=plan._RUN_GROUP))
    assert len(re.findall("Exchange hashpartitioning", best)) == 1
    assert not re.search(r"Join|Window \[", best)


@pytest.mark.parametrize("key_mode", ["concat", "struct"])
def test_lost_claims_of_a_run_are_those_of_linking_again(base, key_mode):
    run = plan.integrate_run(base, (1, 0), key_mode=key_mode)
    for anchor, keys in ((True, LINK_KEYS), (False, EXACT_KEYS)):
        a, b = segment("A", anchor, base), segment("B", anchor, base)
        for paid in (1, 0):
            lost = run.lost().filter((F.col("anchor") == anchor) & (F.col("paid_flag") == paid))
            again = quality.lost_claims(a, b, paid, key_mode, keys=keys)
            assert values(lost, "claim_key") == values(again, "claim_key")
