"""Base tables: one layout for both claim kinds, patients and codes resolved, segments."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.functions import null_if_sentinel, only_for, paid_by_source, paid_flag
from claimlink.schema import (
    CLAIM_COLUMNS,
    CLAIM_SCHEMA,
    CODE_GROUPS,
    DEFAULT_RULES,
    Rules,
)
from claimlink.session import broadcasts
from claimlink.sources import Staging, conform, with_common_numbers


def standardize(raw: DataFrame, kind: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Vendor columns under their common names, still with the original token pair.

    Procedures have no days supply and no status: they count as paid.
    """
    if kind == "procedure":
        days, status = F.lit(None).cast("int"), F.lit(rules.paid_code)
        indicator, paid = F.lit(rules.paid_indicator), F.lit(1)
    elif kind == "treatment":
        days, status = F.col("days_supply"), F.col("treatment_claim_status")
        indicator = F.col("treatment_final_claim_indicator")
        paid = paid_flag(status, rules.paid_statuses)
    else:
        raise ValueError(f"unknown claim kind: {kind!r}")
    return raw.select(
        "datasource",
        "source",
        F.col("patient_token_1").alias("original_token_1"),
        F.col("patient_token_2").alias("original_token_2"),
        only_for(rules.primary, "patient_id").alias("patient_id"),
        F.col(f"{kind}_claim_id").alias("claim_id"),
        "provider_id",
        F.col(f"{kind}_dos").cast("date").alias("dos"),
        days.alias("days_supply"),
        "out_of_pocket",
        "patient_pay",
        status.alias("treatment_claim_status"),
        indicator.alias("treatment_final_claim_indicator"),
        F.col(f"{kind}_code").alias("code"),
        paid.alias("paid_flag"),
    )


BROADCAST_BYTES = 64 * 1024 * 1024


def _measured(table: DataFrame) -> int:
    """Bytes of a table's values as text, and some for each value."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16
             for c in table.columns]
    return table.agg(F.sum(sum(sizes, F.lit(0))).alias("bytes")).first().bytes or 0


def enrich_tokens(
    claims: DataFrame,
    bridge: DataFrame,
    rules: Rules = DEFAULT_RULES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace the original token pair by the bridged one; repeated bridge rows fan out.

    A bridge whose measured size is at most ``broadcast_bytes`` goes to the claims, so that these stay
    where they are; not in a session that has turned broadcasts off. A larger one meets them in a
    shuffled join, which splits claims without tokens at run time.
    """
    if broadcasts(bridge.sparkSession) and _measured(bridge) <= broadcast_bytes:
        bridge = F.broadcast(bridge)
    return (
        claims.join(bridge, ["original_token_1", "original_token_2"], "left")
        .withColumn("patient_token_1", null_if_sentinel("token1", "token2", rules.sentinel))
        .withColumnRenamed("token2", "patient_token_2")
        .drop("original_token_1", "original_token_2", "token1")
    )


def enrich_codes(
    claims: DataFrame, codes: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Attach the code groups.

    Codes are the most skewed key there is, so a reference whose measured size is at most
    ``broadcast_bytes`` goes to the claims; a larger one meets them in a shuffled join, which
    splits hot codes at run time.
    """
    reference = codes.select("code", *CODE_GROUPS)
    if _measured(reference) <= broadcast_bytes:
        reference = F.broadcast(reference)
    return claims.join(reference, "code", "left")


def _resolve(claims: DataFrame, bridge: DataFrame, codes: DataFrame, rules: Rules) -> DataFrame:
    return conform(enrich_codes(enrich_tokens(claims, bridge, rules), codes), CLAIM_SCHEMA)


def paid_treatments(raw: DataFrame, rules: Rules, paid_rule: str) -> DataFrame:
    """Treatments a run starts from: all, or those paid by their vendor's own mark."""
    if paid_rule == "by_source":
        return raw.filter(paid_by_source(rules))
    if paid_rule != "any":
        raise ValueError(f"unknown paid rule: {paid_rule!r}")
    return raw


def base_claims(
    raw: DataFrame,
    bridge: DataFrame,
    codes: DataFrame,
    kind: str,
    rules: Rules = DEFAULT_RULES,
    paid_rule: str = "any",
) -> DataFrame:
    """Claims of one kind in the 19-column layout.

    ``paid_rule="by_source"`` keeps only treatments paid by their vendor's own mark.
    """
    if kind == "treatment":
        raw = paid_treatments(raw, rules, paid_rule)
    return _resolve(standardize(raw, kind, rules), bridge, codes, rules)


def all_claims(
    treatment: DataFrame,
    procedure: DataFrame,
    bridge: DataFrame,
    codes: DataFrame,
    rules: Rules = DEFAULT_RULES,
    paid_rule: str = "any",
) -> DataFrame:
    """Both kinds together. They are unioned first, so the bridge is joined once."""
    treatment = paid_treatments(treatment, rules, paid_rule)
    both = with_common_numbers(
        standardize(treatment, "treatment", rules), standardize(procedure, "procedure", rules)
    )
    return _resolve(both[0].union(both[1]), bridge, codes, rules)


def is_anchor(group1: str = "code_group1"):
    """An anchor claim's code belongs to a first-level code group."""
    return F.col(group1).isNotNull()


PART_VENDOR, PART_ANCHOR = LAYOUT = ["part_vendor", "part_anchor"]
_OTHER_VENDORS = "other"
_IDS = ["claim_id", "patient_id", "patient_token_1", "patient_token_2"]


def _vendor_folder(vendor: str) -> str:
    return f"vendor-{vendor}"


def store_base(
    base: DataFrame, staging: Staging, rules: Rules = DEFAULT_RULES, name: str = "base"
) -> DataFrame:
    """The base claims stored in a folder per vendor, anchor and paid flag.

    ``segment``, ``with_flag`` and a run of one flag then read the folders they need and no others.
    Two columns behind the claim's name the folder; the paid flag is stored in its name alone.
    Vendors but the two linked ones share a folder.
    """
    folder = F.lit(_OTHER_VENDORS)
    for label in (rules.primary, rules.secondary):
        folder = F.when(F.col("datasource") == label, F.lit(_vendor_folder(label))).otherwise(folder)
    laid_out = base.select(
        *CLAIM_COLUMNS,
        folder.alias(PART_VENDOR),
        is_anchor().cast("int").alias(PART_ANCHOR),
    )
    stored = staging.partitioned(laid_out, name, [*LAYOUT, "paid_flag"], _IDS)
    return stored.select(*CLAIM_COLUMNS, *LAYOUT)


def in_folders(
    base: DataFrame, vendors: Sequence[str], anchor: bool | None = None
) -> Column:
    """Condition on the layout of ``store_base``; true for a table without it.

    It holds for all rows that the same condition on the claim's own columns holds for.
    """
    if not set(LAYOUT) <= set(base.columns):
        return F.lit(True)
    wanted = F.col(PART_VENDOR).isin(*map(_vendor_folder, vendors), _OTHER_VENDORS)
    return wanted if anchor is None else wanted & (F.col(PART_ANCHOR) == int(anchor))


def segment(vendor: str, anchor: bool, *bases: DataFrame) -> DataFrame:
    """Anchor or other claims of one vendor, over all given base tables.

    A base of ``store_base`` is read from the folders in question only.
    """
    wanted = (is_anchor() if anchor else ~is_anchor()) & (F.col("datasource") == vendor)
    parts = [
        b.filter(in_folders(b, [vendor], anchor)).select(*CLAIM_COLUMNS).filter(wanted)
        for b in bases
    ]
    return reduce(DataFrame.union, parts)
