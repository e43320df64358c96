"""Every registered query against its SQL."""

from __future__ import annotations

import importlib.util

import pytest
from conftest import DATA
from helpers import duck_rows, rows

import __spark_entry__ as driver
from claimlink import oracle
from claimlink.sources.fixture import inputs

QUERIES, SQL = driver._QUERIES, driver._ORACLE  # without those of claimlink.llm
@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_its_sql(spark, duck, name):
    result = QUERIES[name](spark, DATA)
    columns, expected = duck_rows(duck, SQL[name])
    assert sorted(result.columns) == columns
    assert rows(result) == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_flagship(spark, duck):
    result = driver.entry(spark)
    sql = oracle.with_steps("SELECT count(*) FROM integrated_final")
    assert result.count() == duck.sql(sql).fetchall()[0][0]
    assert {t for _, t in result.dtypes} == {"string", "bigint", "double"}


def test_fixture_reaches_every_rule(spark, duck):
    """Shape of the derived claims: what the rules need does occur."""
    i = inputs(spark, DATA)
    base = i.all_claims()
    assert i.treatment.count() + i.procedure.count() == 6000
    assert base.count() == 6856
    assert base.select("claim_id").distinct().count() == 4599
    for condition in (
        "patient_token_1 IS NULL AND patient_token_2 IS NOT NULL",
        "provider_id IS NULL",
        "out_of_pocket IS NULL",
        "days_supply IS NULL",
        "code_group1 IS NULL",
        "datasource = 'B' AND patient_id IS NULL",
    ):
        assert base.filter(condition).count() > 0


def test_entry_loads_by_path(spark):
    """Also when the loader does not register the module."""
    spec = importlib.util.spec_from_file_location("unregistered_entry", driver.__file__)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(module.queries()) == set(driver.queries())
    assert module.queries()["scan_code_reference"](spark, DATA).count() == 5
