"""Checks on stage tables and on the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.functions import claim_key, completeness_label, concat_key
from claimlink.operators.base import segment
from claimlink.operators.link import linked_claims, with_flag
from claimlink.operators.match import best_matches
from claimlink.operators.sieve import sieve_of
from claimlink.operators.sketch import differing
from claimlink.plans.integrate import Run
from claimlink.schema import DEFAULT_RULES, EXACT_KEYS, LINK_KEYS, Rules
from claimlink.sources import Staging


def reconcile(before: DataFrame, after: DataFrame, before_id: str = "claim_id") -> DataFrame:
    """Distinct claim ids before and after a step, one row each."""

    def count(df: DataFrame, column: str, stage: str) -> DataFrame:
        return df.agg(F.count_distinct(column).alias("distinct_claims")).select(
            F.lit(stage).alias("stage"), "distinct_claims"
        )

    return count(before, before_id, "before").union(count(after, "claim_id", "after"))


def reconcile_keys(df: DataFrame, keysets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct counts of concatenated columns; a NULL part leaves the row out."""
    return df.agg(
        *[F.count_distinct(concat_key(*cols)).alias(name) for name, cols in keysets.items()]
    )


def reconcile_rows(
    before: DataFrame, after: DataFrame, keys: Sequence[str] = ("claim_id",)
) -> DataFrame:
    """Which keys a step has lost, added or multiplied: rows before and after, where they differ.

    Meant for stored stages that should be alike; keys that are alike are not shuffled.
    """
    return differing(before, after, keys)


def claim_ids(*stages: DataFrame) -> DataFrame:
    """Distinct claim ids over one or more stages."""
    parts = [s.select("claim_id") for s in stages]
    return reduce(DataFrame.union, parts).distinct()


def trace(stages: Mapping[str, DataFrame], claim_id: str | Column) -> DataFrame:
    """Rows of one claim in every stage table, with the stage's name."""
    wanted = F.lit(claim_id) if isinstance(claim_id, str) else claim_id
    found = [
        df.filter(F.col("claim_id") == wanted).withColumn("stage", F.lit(name))
        for name, df in stages.items()
    ]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), found)


def summary(integrated: DataFrame) -> DataFrame:
    """Records, patients and encounters by provenance."""
    return integrated.groupBy("data_source").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct("patient_token_2").alias("unique_patients"),
        F.count_distinct("encounter_key").alias("unique_encounters"),
    )


def duplicates(integrated: DataFrame, staging: Staging | None = None) -> DataFrame:
    """Encounter and code combinations with more than one row.

    With ``staging``, for a stored table: mostly few combinations repeat, so hashes of eight bytes are
    counted first, and only rows whose hash may be among the repeated ones (a Bloom filter says so)
    are shuffled with their keys and counted exactly.
    """
    keys = ["encounter_key", "codes"]
    rows = integrated
    if staging is not None:
        digest = F.xxhash64(*keys).alias("_digest")
        counts = integrated.select(digest).groupBy("_digest").agg(F.count(F.lit(1)).alias("n"))
        twice = staging(counts.filter("n > 1").select("_digest"), "seen_twice")
        sieve = sieve_of(twice, staging)
        hashed = integrated.select(*keys, digest)
        if sieve is None:  # too many for a filter
            rows = hashed.join(twice, "_digest", "left_semi")
        else:
            rows = sieve.maybe(hashed, ["_digest"])
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .filter(F.col("record_count") > 1)
    )


def completeness(integrated: DataFrame) -> DataFrame:
    """Rows by presence of provider and cost."""
    return (
        integrated.select(
            completeness_label("provider_id", "Provider").alias("provider_status"),
            completeness_label("out_of_pocket", "Cost").alias("cost_status"),
        )
        .groupBy("provider_status", "cost_status")
        .agg(F.count(F.lit(1)).alias("record_count"))
    )


def lost_claims(
    a: DataFrame,
    b: DataFrame,
    paid: int = 1,
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    keys: Sequence[str] = LINK_KEYS,
) -> DataFrame:
    """Keys of primary claims that are linked on ``keys`` but win no group.

    They are neither in the scenario result nor among the unlinked claims of their run. Anchors
    link on ``LINK_KEYS``, other claims on ``EXACT_KEYS``.
    """
    own, other = with_flag(a, paid), with_flag(b, paid)
    linked = linked_claims(own.union(other), keys, rules)
    used = (
        linked.filter(F.col("datasource") == rules.primary)
        .select(claim_key(mode=key_mode).alias("claim_key"))
        .filter(F.col("claim_key").isNotNull())
        .distinct()
    )
    best = best_matches(own, other, keys, attributes=[], tolerance=rules.tolerance)
    won = best.select(claim_key(mode=key_mode).alias("claim_key"))
    return used.join(won, "claim_key", "left_anti")


def _profile(integrated: DataFrame) -> DataFrame:
    """What the checks need of the final table; few rows are alike, so they are not counted first."""
    return integrated.select(
        "data_source",
        "encounter_key",
        "codes",
        "patient_token_2",
        completeness_label("provider_id", "Provider").alias("provider_status"),
        completeness_label("out_of_pocket", "Cost").alias("cost_status"),
    )


def quality_report(
    raw_ids: DataFrame,
    base: DataFrame,
    integrated: DataFrame,
    paid: Sequence[int] = (1,),
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
    run: Run | None = None,
) -> DataFrame:
    """All checks of a run as rows of (check_name, item, amount).

    ``paid`` names the flags the integrated table was made for. The table is read once: what the
    checks need of it is stored first. With the ``run`` it comes from, lost claims are told from
    what that has stored; without, the base is linked again.
    """
    staging = staging or Staging(base.sparkSession)
    profile = staging(_profile(integrated), "profile")

    def rows(df: DataFrame, check: str, item: Column, amount: str) -> DataFrame:
        return df.select(
            F.lit(check).alias("check_name"),
            item.alias("item"),
            F.col(amount).cast("bigint").alias("amount"),
        )

    measures = ["record_count", "unique_patients", "unique_encounters"]
    by_source = summary(profile)
    repeated = duplicates(profile, staging)
    filled = profile.groupBy("provider_status", "cost_status").agg(F.count(F.lit(1)).alias("n"))

    def relinked(anchor: bool, keys: Sequence[str]) -> DataFrame:
        sides = [segment(v, anchor, base) for v in (rules.primary, rules.secondary)]
        parts = [lost_claims(*sides, p, key_mode, rules, keys) for p in paid]
        return reduce(DataFrame.union, parts).select(F.lit(anchor).alias("anchor"))

    if run is None:
        gone = relinked(True, LINK_KEYS).union(relinked(False, EXACT_KEYS))
    else:
        gone = run.lost()
    scenario = F.explode(
        F.array(*[
            F.struct(F.lit(name).alias("item"), F.col(count).alias("n"))
            for name, count in (("scenario_1", "anchors"), ("scenario_3", "others"))
        ])
    )
    lost = gone.agg(
        F.count_if("anchor").alias("anchors"), F.count_if(~F.col("anchor")).alias("others")
    ).select(scenario.alias("lost")).select("lost.*")

    parts = [
        rows(reconcile(raw_ids, base), "distinct_claims", F.col("stage"), "distinct_claims"),
        by_source.unpivot(["data_source"], measures, "check_name", "amount").select(
            "check_name", F.col("data_source").alias("item"), F.col("amount").cast("bigint")
        ),
        rows(repeated.agg(F.count(F.lit(1)).alias("n")), "duplicate_encounters", F.lit("all"), "n"),
        rows(filled, "completeness", F.concat_ws("/", "provider_status", "cost_status"), "n"),
        rows(lost, "lost_claims", F.col("item"), "n"),
    ]
    return reduce(DataFrame.union, parts)
