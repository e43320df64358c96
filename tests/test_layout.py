"""The stored base: folders per vendor, anchor and flag, of which steps read what they need."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import metric, plan_nodes, rows
from pyspark.sql import functions as F

from claimlink.operators.base import LAYOUT, segment, store_base
from claimlink.operators.link import with_flag
from claimlink.plans import integrate as plan
from claimlink.schema import CLAIM_COLUMNS, CLAIM_SCHEMA, DEFAULT_RULES, Rules
from claimlink.sources import Staging
from claimlink.sources.fixture import inputs

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain(spark):
    return Staging(spark)(inputs(spark, DATA).all_claims(), "plain")


@pytest.fixture(scope="module")
def laid_out(spark, plain):
    return store_base(plain, Staging(spark))


def folders_read(df) -> int:
    df = df.select("*")  # a plan of its own: one that ran before has read already
    df.collect()
    return sum(metric(df, "FileSourceScanExec", "numPartitions"))


def test_nothing_is_lost_or_changed(plain, laid_out):
    assert laid_out.columns == [*CLAIM_COLUMNS, *LAYOUT]
    assert [f.dataType for f in laid_out.schema][:-2] == [f.dataType for f in plain.schema]
    assert rows(laid_out.select(*CLAIM_COLUMNS)) == rows(plain.select(*CLAIM_COLUMNS))


def test_odd_labels_and_flags_come_back_as_they_were(spark, claims):
    """NULL, empty and odd vendors, NULL and odd flags, labels that look like numbers."""
    base = claims(
        *[{"datasource": d, "paid_flag": f, "code_group1": g, "claim_id": f"{d}{f}{g}"}
          for d in ("A", "B", None, "", "1", "x/y=z %", "other", "vendor-A")
          for f in (1, 0, None, -1) for g in ("g", None)]
    )
    for rules in (DEFAULT_RULES, Rules(primary="1", secondary=""), Rules(primary="x/y=z %")):
        stored = store_base(base, Staging(spark), rules)
        assert rows(stored.select(*CLAIM_COLUMNS)) == rows(base)
        for vendor in ("A", "B", "", "1", "x/y=z %", "vendor-A"):
            for anchor in (True, False):
                own = segment(vendor, anchor, stored)
                assert rows(own) == rows(segment(vendor, anchor, base))
                assert rows(with_flag(own, 0)) == rows(with_flag(segment(vendor, anchor, base), 0))


@pytest.mark.parametrize("anchor", [True, False])
@pytest.mark.parametrize("vendor", ["A", "B"])
def test_a_segment_reads_its_folders_only(plain, laid_out, vendor, anchor):
    assert folders_read(laid_out) == 8  # two vendors, anchors or not, paid or not
    own = segment(vendor, anchor, laid_out)
    assert folders_read(own) == 2
    assert folders_read(with_flag(own, 1)) == 1
    assert rows(own) == rows(segment(vendor, anchor, plain))


def test_a_run_of_one_flag_reads_its_folders_only(laid_out):
    assert folders_read(plan.run_claims(laid_out, (1,), DEFAULT_RULES)) == 4
    assert folders_read(plan.run_claims(laid_out, (1, 0), DEFAULT_RULES)) == 8
    text = plan.run_claims(laid_out, (1,), DEFAULT_RULES)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in text and "part_vendor" in text


def test_folders_are_written_without_sorting_the_claims(spark, plain):
    """At most so many folders a task keeps open side by side."""
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 12
    stored = store_base(plain.repartition(3), Staging(spark))
    files = stored.select(F.input_file_name().alias("file")).distinct().count()
    assert files <= 3 * 8


@pytest.mark.parametrize("options", [{}, {"leftovers": "own_flag"}, {"exclude": "winners"}])
def test_integration_is_the_same_over_either_layout(spark, plain, laid_out, options):
    results = [plan.integrate(base, (1, 0), **options) for base in (plain, laid_out)]
    assert rows(results[0]) == rows(results[1])


def test_empty_base(spark):
    stored = store_base(spark.createDataFrame([], CLAIM_SCHEMA), Staging(spark))
    assert stored.columns == [*CLAIM_COLUMNS, *LAYOUT] and stored.count() == 0
    assert plan.integrate(stored, (1, 0)).count() == 0


def test_ids_are_written_without_dictionaries(plain, spark):
    """Each has very many values: a dictionary per folder and task would be filled and thrown away."""
    staging = Staging(spark)
    store_base(plain, staging)
    folder = Path(staging.folder.removeprefix("file://").removeprefix("file:"))
    files = list(folder.rglob("*.parquet"))
    assert files
    for file in files:
        meta = pq.ParquetFile(file.open("rb")).metadata
        chunks = [meta.row_group(0).column(k) for k in range(meta.num_columns)]
        kinds = {c.path_in_schema: c.has_dictionary_page for c in chunks}
        assert not any(kinds[c] for c in kinds if c in ("claim_id", "patient_id"))
        assert not any(kinds[c] for c in kinds if c.startswith("patient_token"))
        assert kinds["code"]


def test_lines_and_orders_meet_without_a_sort(spark):
    for raw in (inputs(spark, DATA).treatment, inputs(spark, DATA).procedure):
        raw.collect()
        nodes = [n.getClass().getSimpleName() for n in plan_nodes(raw)]
        assert "ShuffledHashJoinExec" in nodes
        assert not {"SortExec", "SortMergeJoinExec", "BroadcastHashJoinExec"} & set(nodes)
