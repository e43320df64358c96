"""Base tables and stored steps."""

from __future__ import annotations

from datetime import date

import pytest
from helpers import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlink.operators.base import all_claims, base_claims, segment, standardize
from claimlink.operators.link import exact_pairs, ledger
from claimlink.plans import quality
from claimlink.plans.integrate import integrate
from claimlink.schema import (
    BRIDGE_SCHEMA,
    CLAIM_SCHEMA,
    CODES_SCHEMA,
    DAY_TOLERANCE,
    EXACT_KEYS,
    FILL_ATTRIBUTES,
    LINK_KEYS,
    NO_PATIENT_SENTINEL,
    PAID_STATUSES,
    RANK_GROUP,
    Rules,
    raw_schema,
)
from claimlink.session import staging_root
from claimlink.sources import (
    Staging,
    conform,
    exact_type,
    load_bridge,
    load_claims,
    load_codes,
    save,
)


@pytest.fixture(scope="module")
def treatment(spark):
    day = date(2020, 1, 1)
    rows = [
        ("A", "s", "o1", "o2", "id1", "t1", "p", day, 30, None, None, "PAID", "PAID", "c"),
        ("B", "s", "o1", "o2", "id2", "t2", "p", day, 30, None, None, "1", None, "c"),
        ("B", "s", "n1", "n2", "id3", "t3", "p", day, 30, None, None, "0", "PAID", "x"),
        ("A", "s", "s1", "s2", "id4", "t4", "p", day, 30, None, None, None, None, "d"),
        ("A", "s", None, "o2", "id5", "t5", "p", day, 30, None, None, "1", None, None),
    ]
    return spark.createDataFrame(rows, raw_schema("treatment"))


@pytest.fixture(scope="module")
def procedure(spark):
    rows = [("B", "s", "o1", "o2", "id6", "p1", None, date(2020, 1, 2), None, None, "c")]
    return spark.createDataFrame(rows, raw_schema("procedure"))


@pytest.fixture(scope="module")
def bridge(spark):
    rows = [
        ("o1", "o2", "b1", "b2"),
        ("s1", "s2", "b3", "XXX - F00000"),
        ("s1", "s2", "b4", "b5"),
        (None, "o2", "never", "never"),
    ]
    return spark.createDataFrame(rows, BRIDGE_SCHEMA)


@pytest.fixture(scope="module")
def codes(spark):
    rows = [
        ("c", "g", None, None, None),
        ("d", None, "h", None, None),
        ("d", "g", None, None, None),
    ]
    return spark.createDataFrame(rows, CODES_SCHEMA)


def test_treatment_rules(treatment, bridge, codes):
    base = base_claims(treatment, bridge, codes, "treatment")
    assert base.columns == CLAIM_SCHEMA.fieldNames()
    assert [f.dataType for f in base.schema] == [f.dataType for f in CLAIM_SCHEMA]
    found = values(
        base.filter("claim_id <> 't4'"),
        "claim_id",
        "patient_token_1",
        "patient_token_2",
        "patient_id",
        "paid_flag",
        "code_group1",
    )
    assert found == [
        ("t1", "b1", "b2", "id1", 1, "g"),
        ("t2", "b1", "b2", None, 1, "g"),
        ("t3", None, None, None, 0, None),
        ("t5", None, None, "id5", 1, None),
    ]


def test_repeated_bridge_and_code_rows_fan_out(treatment, bridge, codes):
    base = base_claims(treatment, bridge, codes, "treatment").filter("claim_id = 't4'")
    found = values(base, "patient_token_1", "patient_token_2", "code_group1", "paid_flag")
    assert found == [
        ("b4", "b5", "g", 0),
        ("b4", "b5", None, 0),
        (None, "XXX - F00000", "g", 0),
        (None, "XXX - F00000", None, 0),
    ]


def test_procedures_count_as_paid(procedure, bridge, codes):
    row = base_claims(procedure, bridge, codes, "procedure").first()
    assert (row.treatment_claim_status, row.treatment_final_claim_indicator) == ("1", "PAID")
    assert (row.paid_flag, row.days_supply, row.patient_id) == (1, None, None)


def test_one_join_for_both_kinds(treatment, procedure, bridge, codes):
    parts = base_claims(treatment, bridge, codes, "treatment").union(
        base_claims(procedure, bridge, codes, "procedure")
    )
    whole = all_claims(treatment, procedure, bridge, codes)
    columns = whole.columns
    assert values(whole, *columns) == values(parts, *columns)


def test_paid_rule_by_source(treatment, bridge, codes):
    base = base_claims(treatment, bridge, codes, "treatment", paid_rule="by_source")
    assert values(base, "claim_id") == [("t1",), ("t2",)]
    with pytest.raises(ValueError):
        base_claims(treatment, bridge, codes, "treatment", paid_rule="some")


def test_vendor_labels_are_parameters(treatment):
    swapped = standardize(treatment, "treatment", Rules(primary="B", secondary="A"))
    found = values(swapped.filter("patient_id IS NOT NULL"), "datasource", "patient_id")
    assert found == [("B", "id2"), ("B", "id3")]


def test_unknown_kind(treatment):
    with pytest.raises(ValueError):
        standardize(treatment, "visit")


def test_load_by_path_and_by_name(spark, treatment, bridge, codes, tmp_path):
    raw = treatment.withColumnRenamed("source", "feed").withColumn("unused", F.lit(1))
    save(raw, f"{tmp_path}/treatment")
    loaded = load_claims(spark, f"{tmp_path}/treatment", "treatment", {"source": "feed"})
    assert loaded.schema.names == raw_schema("treatment").fieldNames()
    assert loaded.count() == treatment.count()
    groups = {f"code_group{i}": f"class{i}" for i in range(1, 5)}
    save(codes.withColumnsRenamed(groups), f"{tmp_path}/codes")
    assert load_codes(spark, f"{tmp_path}/codes", groups).columns == codes.columns
    save(bridge, "bridge_table")
    save(bridge.limit(1), "bridge_table")
    assert load_bridge(spark, "bridge_table").count() == 1


def test_stored_steps_are_never_overwritten(spark):
    staging = Staging(spark)
    assert staging.folder.startswith(staging_root(spark))
    first = staging(spark.range(3), "step")
    second = staging(spark.range(5), "step")
    assert (first.count(), second.count()) == (3, 5)


def test_checks(treatment, bridge, codes):
    base = base_claims(treatment, bridge, codes, "treatment")
    before_after = quality.reconcile(treatment, base, "treatment_claim_id")
    assert values(before_after, "stage", "distinct_claims") == [("after", 5), ("before", 5)]
    keys = {"one": ["patient_token_2", "claim_id"], "two": ["patient_token_1", "claim_id"]}
    counts = quality.reconcile_keys(base, keys).first()
    assert (counts.one, counts.two) == (4, 3)
    found = quality.trace({"base": base, "raw": base.select("claim_id")}, "t2")
    assert values(found, "stage", "claim_id", "code") == [("base", "t2", "c"), ("raw", "t2", None)]
    assert quality.claim_ids(base, base).count() == 5


def raw_treatments(spark, days, amounts, kind="decimal(12,3)", days_kind="decimal(6,2)"):
    """One treatment per amount, in the vendor's own number types."""
    rows = [
        (("A", "B")[i % 2], "s", "o1", "o2", "p", f"t{i}", "prov", "2020-01-01", str(d), str(x),
         "1", "1", "PAID", "c")
        for i, (d, x) in enumerate(zip(days, amounts, strict=True))
    ]
    names = [f.name for f in raw_schema("treatment")]
    return spark.createDataFrame(rows, [n for n in names]).withColumns({
        "treatment_dos": F.to_date("treatment_dos"),
        "days_supply": F.col("days_supply").cast(days_kind),
        "out_of_pocket": F.col("out_of_pocket").cast(kind),
        "patient_pay": F.col("patient_pay").cast(kind),
    })


def test_numbers_keep_all_their_digits(spark):
    """Amounts that differ in the third decimal do not link, and days keep their fraction."""
    schema = raw_schema("treatment")
    raw = conform(raw_treatments(spark, ["30.75", "30.75"], ["1.001", "1.004"]), schema)
    same = conform(raw_treatments(spark, ["30.75", "30.75"], ["1.001", "1.001"]), schema)
    bridge = spark.createDataFrame([("o1", "o2", "t1", "t2")], BRIDGE_SCHEMA)
    codes = spark.createDataFrame([("x", None, None, None, None)], CODES_SCHEMA)
    procedures = spark.createDataFrame([], raw_schema("procedure"))
    for rows, pairs in ((raw, 0), (same, 1)):
        base = all_claims(rows, procedures, bridge, codes)
        assert {str(r.days_supply) for r in base.collect()} == {"30.75"}
        assert exact_pairs(segment("A", False, base), segment("B", False, base)).count() == pairs
        assert ledger(base, EXACT_KEYS).count() == 2 * pairs
        both = integrate(base).filter("data_source = 'Both'")
        assert both.count() == pairs


def test_numbers_meet_in_a_type_that_holds_both():
    d = T.DecimalType
    assert exact_type(d(18, 2), d(18, 2)) == d(18, 2)
    assert exact_type(d(18, 2), d(12, 5)) == d(21, 5)
    assert exact_type(T.IntegerType(), d(6, 2)) == d(12, 2)
    with pytest.raises(ValueError):
        exact_type(d(38, 2), d(38, 6))


@pytest.mark.parametrize("kind", ["double", "string", "float"])
def test_inexact_amounts_are_refused(spark, kind):
    with pytest.raises(ValueError, match="decimal"):
        conform(raw_treatments(spark, ["1"], ["1"], kind), raw_schema("treatment"))


def test_fixed_values():
    """What results are defined by, written out once more."""
    assert (NO_PATIENT_SENTINEL, PAID_STATUSES, DAY_TOLERANCE) == ("XXX - F00000", ("1", "PAID"), 5)
    assert LINK_KEYS == ["patient_token_1", "patient_token_2", "code"]
    assert EXACT_KEYS == [*LINK_KEYS, "provider_id", "out_of_pocket", "patient_pay"]
    assert RANK_GROUP == ["patient_token_2", "code", "dos"]
    assert FILL_ATTRIBUTES == ["provider_id", "out_of_pocket", "patient_pay", "days_supply"]
