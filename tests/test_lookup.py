"""Lookups of claims in stored stages: the rows of a scan, from the files in question only."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from helpers import metric, rows
from pyspark.sql import functions as F

import __spark_entry__ as driver
from claimlink.operators.base import segment
from claimlink.plans import quality, scenarios
from claimlink.plans.lookup import store_for_lookup, trace_stored
from claimlink.sources import Staging
from claimlink.sources.fixture import inputs

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base(spark):
    return Staging(spark)(inputs(spark, DATA).all_claims(), "base")


@pytest.fixture(scope="module")
def stages(spark, base):
    a, b = segment("A", True, base), segment("B", True, base)
    return {"base": base, "primary_anchor": a, "scenario_1": scenarios.scenario_1(a, b)}


@pytest.fixture(scope="module")
def stored(spark, stages):
    staging = Staging(spark)
    return {n: store_for_lookup(df, staging, n, files=20) for n, df in stages.items()}


def test_stored_tables_hold_the_same_rows(stages, stored):
    for name, df in stages.items():
        assert stored[name].rows.columns == df.columns
        assert rows(stored[name].rows) == rows(df)


def test_a_lookup_finds_what_a_scan_finds(base, stages, stored):
    ids = [r.claim_id for r in base.select("claim_id").distinct().orderBy("claim_id").collect()]
    for wanted in (*ids[:3], ids[len(ids) // 2], ids[-1], "not there", "", "zzz"):
        scan = quality.trace(stages, wanted)
        found = trace_stored(stored, wanted)
        assert found.columns == scan.columns
        assert rows(found) == rows(scan)


def test_several_claims_at_once(base, stored):
    ids = [r.claim_id for r in base.select("claim_id").distinct().limit(5).collect()]
    found = stored["base"].find(*ids)
    assert rows(found) == rows(base.filter(F.col("claim_id").isin(*ids)))


def test_a_lookup_opens_one_file(base, stored):
    """Of twenty; an id at the edge of two ranges may lie in both."""
    table = stored["base"]
    assert table.files.count() == 20
    ids = [r.claim_id for r in base.select("claim_id").distinct().collect()]
    opened = [len(table.files_with([i])) for i in ids]
    assert min(opened) == 1 and max(opened) <= 2
    assert sum(opened) < 1.05 * len(ids)
    found = table.find(ids[0])
    found.collect()
    assert sum(metric(found, "FileSourceScanExec", "numFiles")) == opened[0]
    assert table.files_with(["~"]) == [] and table.find("~").columns == base.columns


def test_files_are_sorted_and_carry_bloom_filters(stored):
    for r in stored["base"].files.collect():
        path = r.file.removeprefix("file://").removeprefix("file:")
        ids = pq.read_table(path, columns=["claim_id"]).column("claim_id").to_pylist()
        assert ids == sorted(ids)
        assert (ids[0], ids[-1]) == (r.least, r.greatest)
        with open(path, "rb") as file:
            meta = pq.ParquetFile(file).metadata
            column = meta.row_group(0).column(meta.schema.names.index("claim_id"))
            assert column.statistics.has_min_max


def test_a_claim_with_very_many_rows_lies_in_several_files(spark):
    hot = spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("claim_id"),
        F.col("id").alias("n"),
    )
    table = store_for_lookup(hot, Staging(spark), "hot", files=9)
    assert len(table.files_with(["hot"])) >= 5
    assert table.find("hot").count() == 2000
    assert len(table.files_with(["c2500"])) == 1


def test_rows_without_an_id_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("", 4)], "claim_id string, n int")
    table = store_for_lookup(df, Staging(spark), "few", files=3)
    assert rows(table.rows) == rows(df)
    assert [r.n for r in table.find("a").collect()] == [3]
    assert [r.n for r in table.find("").collect()] == [4]
    empty = store_for_lookup(df.limit(0), Staging(spark), "none")
    assert empty.files.count() == 0 and empty.find("a").collect() == []
    assert trace_stored({"none": empty, "few": table}, "a").count() == 1
    with pytest.raises(ValueError):
        store_for_lookup(df.withColumn("_spread", F.lit(1)), Staging(spark), "clash")


def test_one_claim_is_traced_by_scans(spark, monkeypatch):
    """The query stores the base and what linking needs, no table in order of the claim id."""
    names, save = [], Staging.path
    monkeypatch.setattr(Staging, "path", lambda self, name: names.append(name) or save(self, name))
    found = driver._QUERIES["trace_claim"](spark, DATA)
    assert found.count() > 0
    assert names.count("base") == 1 and "primary_anchor" not in names and "ranked_1_paid" not in names
    plans = found._jdf.queryExecution().toString()
    assert plans.count("EqualTo(claim_id") >= 2  # the scans of base and anchors skip what cannot hold it
