"""Claims tables derived from the order tables, for tests, benchmark and driver.

Twenty customers make one patient; odd line numbers are the primary vendor's claims, even ones
the secondary's. NULLs, repeated ids, unbridged patients, the sentinel token and a bridge
fan-out occur on purpose.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlink.operators.base import all_claims, base_claims
from claimlink.schema import (
    BRIDGE_SCHEMA,
    CODES_SCHEMA,
    DEFAULT_RULES,
    NO_PATIENT_SENTINEL,
    raw_schema,
)
from claimlink.sources.tables import conform


@dataclass(frozen=True)
class Inputs:
    """The four input tables."""

    treatment: DataFrame
    procedure: DataFrame
    bridge: DataFrame
    codes: DataFrame

    def base(self, kind: str, paid_rule: str = "any") -> DataFrame:
        return base_claims(
            getattr(self, kind), self.bridge, self.codes, kind, DEFAULT_RULES, paid_rule
        )

    def all_claims(self) -> DataFrame:
        return all_claims(self.treatment, self.procedure, self.bridge, self.codes)


def _patient(customer_key: str):
    return F.floor(F.col(customer_key) / 20).cast("bigint")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    line = F.col("l_linenumber")
    vendor = F.when(line % 2 == 1, F.lit("A")).otherwise(F.lit("B"))
    amount = F.round(F.col("l_discount") * 100).cast("int") % 2
    pay = F.round(F.col("l_tax") * 100).cast("int") % 2
    # Two fact tables: shuffled at every size, so a small single-file copy gets parallel too. A task's
    # share of the orders, two whole numbers a row, is hashed, so that no lines are sorted.
    joined = lineitem.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        vendor.alias("datasource"),
        F.concat(F.lit("S"), line % 3).alias("source"),
        F.concat(F.lit("O1-"), _patient("o_custkey")).alias("patient_token_1"),
        F.concat(F.lit("O2-"), _patient("o_custkey")).alias("patient_token_2"),
        F.concat(F.lit("PID-"), "o_custkey").alias("patient_id"),
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("claim_id"),
        F.when(F.col("l_suppkey") % 4 != 0, (F.col("l_suppkey") % 2).cast("string")).alias(
            "provider_id"
        ),
        F.col("l_shipdate").cast("date").alias("dos"),
        F.when(F.col("l_quantity") > 15, F.col("l_quantity").cast("int")).alias("days_supply"),
        F.when(F.col("l_discount") >= 0.02, amount).alias("out_of_pocket"),
        F.when(F.col("l_tax") >= 0.01, pay).alias("patient_pay"),
        F.when(
            F.col("l_linestatus") == "F",
            F.when(vendor == "A", F.lit("PAID")).otherwise(F.lit("1")),
        )
        .otherwise(F.lit("0"))
        .alias("status"),
        F.when(F.col("l_linestatus") == "F", F.lit("PAID"))
        .otherwise(F.lit("REJECTED"))
        .alias("indicator"),
        F.concat(F.lit("C"), F.col("l_partkey") % 6).alias("code"),
        "l_returnflag",
    )


def _as_kind(lines: DataFrame, kind: str) -> DataFrame:
    names = {
        f"{kind}_claim_id": "claim_id",
        f"{kind}_dos": "dos",
        f"{kind}_code": "code",
        "treatment_claim_status": "status",
        "treatment_final_claim_indicator": "indicator",
    }
    return conform(lines, raw_schema(kind), names)


def _bridge(spark: SparkSession, folder: str) -> DataFrame:
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    pat = F.col("pat")
    token = F.concat(F.lit("P1-"), pat)
    return conform(
        customer.select(_patient("c_custkey").alias("pat"))
        .distinct()
        .filter(pat % 37 != 5)
        .select(
            F.concat(F.lit("O1-"), pat).alias("original_token_1"),
            F.concat(F.lit("O2-"), pat).alias("original_token_2"),
            F.explode(
                F.when(pat % 29 == 3, F.array(token, F.concat(token, F.lit("-alt")))).otherwise(
                    F.array(token)
                )
            ).alias("token1"),
            F.when(pat % 20 == 0, F.lit(NO_PATIENT_SENTINEL))
            .otherwise(F.concat(F.lit("P2-"), pat))
            .alias("token2"),
        ),
        BRIDGE_SCHEMA,
    )


def _codes(spark: SparkSession, folder: str) -> DataFrame:
    part = spark.read.parquet(f"{folder}/part.parquet")
    kind = F.col("kind")
    known = kind <= 3
    return conform(
        part.select((F.col("p_partkey") % 6).alias("kind"))
        .distinct()
        .filter(kind != 5)
        .select(
            F.concat(F.lit("C"), kind).alias("code"),
            F.when(known, F.concat(F.lit("G"), kind % 2)).alias("code_group1"),
            F.when(known, F.concat(F.lit("H"), kind)).alias("code_group2"),
            F.when(kind <= 1, F.lit("I")).alias("code_group3"),
            F.lit(None).alias("code_group4"),
        ),
        CODES_SCHEMA,
    )


def inputs(spark: SparkSession, folder: str) -> Inputs:
    """The four claims tables from the order tables in ``folder``."""
    lines = _lines(spark, folder)
    procedure = F.col("l_returnflag") == "R"
    return Inputs(
        treatment=_as_kind(lines.filter(~procedure), "treatment"),
        procedure=_as_kind(lines.filter(procedure), "procedure"),
        bridge=_bridge(spark, folder),
        codes=_codes(spark, folder),
    )
