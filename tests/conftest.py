from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from claimlink.schema import CLAIM_SCHEMA  # noqa: E402
from claimlink.session import configure  # noqa: E402

DATA = "/root/testdata/sf0.001"
TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("claimlink-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    )
    session = configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


@pytest.fixture
def claims(spark):
    """Builds claim rows from dicts; what is not given gets a harmless default."""
    from datetime import date, timedelta
    from decimal import Decimal

    default = {
        "datasource": "A",
        "source": "s",
        "patient_token_1": "t1",
        "patient_token_2": "t2",
        "patient_id": None,
        "claim_id": "a1",
        "provider_id": None,
        "dos": 10,
        "days_supply": None,
        "out_of_pocket": None,
        "patient_pay": None,
        "treatment_claim_status": "1",
        "treatment_final_claim_indicator": "PAID",
        "code": "c",
        "code_group1": "g",
        "code_group2": None,
        "code_group3": None,
        "code_group4": None,
        "paid_flag": 1,
    }

    def build(*rows: dict):
        table = []
        for row in rows:
            full = {**default, **row}
            if isinstance(full["dos"], int):
                full["dos"] = date(2020, 1, 1) + timedelta(days=full["dos"])
            for money in ("out_of_pocket", "patient_pay"):
                if full[money] is not None:
                    full[money] = Decimal(full[money])
            table.append(tuple(full[c] for c in CLAIM_SCHEMA.fieldNames()))
        return spark.createDataFrame(table, CLAIM_SCHEMA)

    return build
