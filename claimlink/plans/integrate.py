"""One table of linked and unlinked claims with provenance.

``integrate`` builds it for one paid flag or for both at once. Both scenarios and both flags
go through the same few shuffles: the flag, the segment and, for non-anchor claims, the three
exact attributes are link keys like the patient tokens and the code.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlink.functions import claim_key
from claimlink.operators.antijoin import ledger_sieve, not_in, not_in_every
from claimlink.operators.base import all_claims, in_folders, is_anchor, segment, store_base
from claimlink.operators.match import (
    best_matches,
    best_of,
    linked_only,
    linked_sides,
    met_days,
    vendor_rows,
)
from claimlink.operators.near import near
from claimlink.operators.sieve import Sieve, sieve_of
from claimlink.plans import scenarios
from claimlink.schema import (
    CLAIM_COLUMNS,
    DEFAULT_RULES,
    FILL_ATTRIBUTES,
    INTEGRATED_COLUMNS,
    LINK_KEYS,
    RANK_GROUP,
    Rules,
)
from claimlink.session import broadcasts, configure, input_bytes
from claimlink.sources import Staging

PAID, NON_PAID = 1, 0

_RENAMED = {"encounter_key": "claim_id", "svc_date": "dos", "codes": "code"}
_TELLING = [
    "claim_id", "code", "dos", "patient_token_1", "provider_id", "out_of_pocket", "patient_pay",
    "paid_flag",
]
_RUN_KEYS = ["anchor", "paid_flag", *LINK_KEYS, "link_attributes"]
_RUN_GROUP = ["anchor", "paid_flag", *RANK_GROUP]


def to_integrated(df: DataFrame, provenance, filled: Sequence[str] = ()) -> DataFrame:
    """The 20-column layout; ``filled`` names the columns taken from ``final_<column>``."""

    def source(c: str):
        if c == "data_source":
            return provenance
        return F.col(f"final_{c}" if c in filled else _RENAMED.get(c, c))

    return df.select(*[source(c).alias(c) for c in INTEGRATED_COLUMNS])


def purge(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Drop unlinked secondary rows without any patient identity."""
    unidentified = (
        (F.col("data_source") == rules.secondary)
        & F.col("patient_token_1").isNull()
        & F.col("patient_token_2").isNull()
        & F.col("patient_id").isNull()
    )
    return df.filter(~F.coalesce(unidentified, F.lit(False)))


def leg_scenario_1(scenario_1: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Linked anchor claims with their filled values."""
    filled = ["provider_id", "days_supply", "out_of_pocket", "patient_pay"]
    return to_integrated(scenario_1, F.lit(rules.both), filled).distinct()


def leg_scenario_3(
    scenario_3: DataFrame,
    ledger_1: DataFrame,
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Exactly linked non-anchor claims that scenario 1 has not used."""
    keyed = scenario_3.withColumn("claim_key", claim_key(mode=key_mode))
    rest = not_in(keyed, "claim_key", ledger_1)
    return to_integrated(rest, F.lit(rules.both), ["days_supply"]).distinct()


def leg_rest(
    segment: DataFrame,
    vendor: str,
    ledger_1: DataFrame,
    ledger_3: DataFrame,
    key_mode: str = "concat",
    staging: Staging | None = None,
) -> DataFrame:
    """Claims of a segment that neither scenario has used.

    The key stays in the DISTINCT, as in ``_rest``; with ``staging``, for a stored segment and stored
    ledgers, only rows that may be used or repeated are shuffled.
    """
    keyed = segment.select(*CLAIM_COLUMNS, claim_key(mode=key_mode).alias("claim_key"))
    used = ledger_1.union(ledger_3)
    parts = _settled(keyed, used, staging) if staging and broadcasts(used.sparkSession) else None
    if parts is None:
        rest = not_in(keyed, "claim_key", used).distinct()
    else:
        settled, doubtful = parts
        rest = not_in(settled, "claim_key", used, unlisted=True).union(
            not_in(doubtful, "claim_key", used).distinct()
        )
    return to_integrated(rest, F.lit(vendor))


def distinct_rows(df: DataFrame, staging: Staging) -> DataFrame:
    """DISTINCT of a table in which few rows repeat: it is stored, and only those are shuffled."""
    if not broadcasts(df.sparkSession):
        return df.distinct()
    stored = staging(df, "rows").select("*", F.xxhash64(*df.columns).alias("_digest"))
    repeated = _repeated(stored.select("_digest"), staging)
    if repeated is None:
        return stored.select(*df.columns).distinct()
    marked = repeated.marked(stored, ["_digest"], "_repeated")
    once, often = (marked.filter(c).select(*df.columns)
                   for c in (~F.col("_repeated"), F.col("_repeated")))
    return once.union(often.distinct())


def _repeated(digests: DataFrame, staging: Staging) -> Sieve | None:
    """The sieve of hashes (column ``_digest``) that occur more than once."""
    counts = digests.groupBy("_digest").agg(F.count(F.lit(1)).alias("n"))
    return sieve_of(staging(counts.filter("n > 1").select("_digest"), "repeated"), staging)


def run_claims(base: DataFrame, runs: Sequence[int], rules: Rules) -> DataFrame:
    """Claims of both vendors with the columns that tell runs and scenarios apart.

    ``link_attributes`` is what non-anchor claims must agree on beyond patient and code; it is
    NULL, and the claim cannot link, when one of the three is. The two amounts come first: they
    cannot hold the separator.
    """
    anchor = is_anchor()
    exact = F.concat(
        F.col("out_of_pocket").cast("string"),
        F.lit("|"),
        F.col("patient_pay").cast("string"),
        F.lit("|"),
        F.col("provider_id"),
    )
    vendors = rules.primary, rules.secondary
    return (
        base.filter(in_folders(base, vendors))
        .filter(F.col("datasource").isin(*vendors) & F.col("paid_flag").isin(*runs))
        .select(*CLAIM_COLUMNS)
        .withColumn("anchor", anchor)
        .withColumn("link_attributes", F.when(anchor, F.lit("")).otherwise(exact))
    )


def _both_legs(
    met: DataFrame,
    used: DataFrame,
    claims: DataFrame,
    runs: Sequence[int],
    exclude: str,
    key_mode: str,
    rules: Rules,
) -> DataFrame:
    """Winners of both scenarios. They have one row per group, so no DISTINCT is needed."""
    best = best_of(met, _RUN_KEYS, group=_RUN_GROUP)
    filled = ["provider_id", "days_supply", "out_of_pocket", "patient_pay"]
    both = F.lit(rules.both)

    # Non-anchor winners must not be used by scenario 1. They agree with their partner on three
    # of the four filled attributes, so those "final" values are their own.
    best = best.withColumn("claim_key", claim_key(mode=key_mode)).withColumn(
        "non_anchor", ~F.col("anchor")
    )
    by_scenario_1 = used.filter("anchor").select("paid_flag", "claim_key")
    kept = not_in(best, "claim_key", by_scenario_1, "paid_flag", runs, tested="non_anchor")
    legs = to_integrated(kept, both, filled)
    if exclude == "all":
        return legs
    if exclude != "winners":
        raise ValueError(f"unknown exclusion: {exclude!r}")
    taken = best.filter("anchor").select(
        "paid_flag", claim_key("other_claim_id", "code", key_mode).alias("claim_key")
    )
    own, other = (
        claims.filter(F.col("anchor") & (F.col("datasource") == vendor))
        for vendor in (rules.primary, rules.secondary)
    )
    reverse = other.withColumn("claim_key", claim_key(mode=key_mode))
    reverse_best = best_matches(
        not_in(reverse, "claim_key", taken, "paid_flag", runs),
        own,
        _RUN_KEYS,
        group=_RUN_GROUP,
        tolerance=rules.tolerance,
    )
    return legs.union(to_integrated(reverse_best, both, filled))


def _rest(
    base: DataFrame,
    used: DataFrame,
    runs: Sequence[int],
    leftovers: str,
    purged: bool,
    key_mode: str,
    rules: Rules,
    staging: Staging | None = None,
) -> DataFrame:
    """Unlinked claims of all four segments.

    The key stays in the DISTINCT: it changes nothing there, and the rows are already
    partitioned by it. With ``staging``, for a stored base, only rows that may be used or repeated
    are shuffled for it (``_settled``); all others are in the result as they stand.
    """
    keys = used.select("paid_flag", "claim_key")
    rows = _rest_rows(base, runs, leftovers, purged, key_mode, rules)

    def unused(rows: DataFrame, **options) -> DataFrame:
        if leftovers == "own_flag":
            return not_in(rows, "claim_key", keys, "paid_flag", runs, **options)
        return not_in_every(rows, "claim_key", keys, "paid_flag", runs, **options)

    parts = _settled(rows, used, staging) if staging and broadcasts(base.sparkSession) else None
    if parts is None:
        rest = unused(rows).distinct()
    else:
        settled, doubtful = parts
        rest = unused(settled, unlisted=True).union(unused(doubtful).distinct())
    return to_integrated(rest, F.col("datasource"))


def _rest_rows(
    base: DataFrame,
    runs: Sequence[int],
    leftovers: str,
    purged: bool,
    key_mode: str,
    rules: Rules,
) -> DataFrame:
    """The claims, with their key, that the unlinked ones are among."""
    vendors = rules.primary, rules.secondary
    claims = base.filter(in_folders(base, vendors)).filter(F.col("datasource").isin(*vendors))
    if leftovers not in ("own_flag", "all"):
        raise ValueError(f"unknown leftovers: {leftovers!r}")
    if leftovers == "own_flag":
        claims = claims.filter(F.col("paid_flag").isin(*runs))
    if purged:
        keep = purge(claims.withColumn("data_source", F.col("datasource")), rules)
        claims = keep.drop("data_source")
    return claims.select(*CLAIM_COLUMNS, claim_key(mode=key_mode).alias("claim_key"))


def _settled(
    rows: DataFrame, used: DataFrame, staging: Staging
) -> tuple[DataFrame, DataFrame] | None:
    """Rows whose key is certainly not used and that certainly occur once, and all others.

    Rows are counted by a hash of eight bytes over the columns that mostly tell claims apart; hashes that
    repeat and the used keys make two sieves. Equal rows are on the same side, and rows that agree on
    these columns only are in doubt with them. None if either list is too long for a sieve.
    """
    digest = F.xxhash64(*_TELLING).alias("_digest")
    repeated = _repeated(rows.select(digest), staging)
    listed = ledger_sieve(used.select("claim_key"), staging)
    if repeated is None or listed is None:
        return None
    marked = repeated.marked(rows.select("*", digest), ["_digest"], "_repeated")
    marked = listed.marked(marked, ["claim_key"], "_listed")
    doubt = F.col("_repeated") | F.col("_listed")
    return marked.filter(~doubt).select(*rows.columns), marked.filter(doubt).select(*rows.columns)


@dataclass(frozen=True)
class Run:
    """An integrated table and what its making stored.

    ``met`` has the linked days with their partners (``match.linked_only``), ``used`` the keys of all
    linked claims as (anchor, paid_flag, datasource, claim_key).
    """

    result: DataFrame
    met: DataFrame
    used: DataFrame
    rules: Rules
    key_mode: str

    def lost(self) -> DataFrame:
        """(anchor, paid_flag, claim_key) of linked primary claims that win no group.

        They are neither in the result as linked nor among the unlinked claims of their flag.
        """
        keys = ["anchor", "paid_flag", "claim_key"]
        primary = self.used.filter(F.col("datasource") == self.rules.primary)
        best = best_of(self.met, _RUN_KEYS, attributes=[], group=_RUN_GROUP)
        won = best.select("anchor", "paid_flag", claim_key(mode=self.key_mode).alias("claim_key"))
        known = primary.filter(F.col("claim_key").isNotNull()).select(*keys).distinct()
        return known.join(won, keys, "left_anti")


def integrate_run(
    base: DataFrame,
    runs: Sequence[int] = (PAID,),
    purged: bool = True,
    leftovers: str = "all",
    exclude: str = "all",
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
) -> Run:
    """``integrate``, with the stored steps that checks can go on from.

    Claims that may have a partner are told by hashes and stored (``operators/near.py``). One sweep over
    the days of their link keys says which days are linked and with which partners; its outcome and
    the keys of the linked claims, which all later steps read, are stored by this call. ``base`` is
    read five times and should be a stored table, too.
    """
    staging = staging or Staging(base.sparkSession)
    both, met, used = _linked_run(base, runs, exclude, key_mode, rules, staging)
    rest = _rest(base, used, runs, leftovers, purged, key_mode, rules, staging)
    return Run(both.union(rest), met, used, rules, key_mode)


def _linked_run(
    base: DataFrame,
    runs: Sequence[int],
    exclude: str,
    key_mode: str,
    rules: Rules,
    staging: Staging,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The linked claims of ``integrate_run``, and the ``met`` and ``used`` of its ``Run``."""
    vendor = F.col("datasource")
    claims = staging(
        near(
            run_claims(base, runs, rules),
            _RUN_KEYS,
            vendor == rules.primary,
            vendor == rules.secondary,
            rules.tolerance,
            staging,
        ),
        "near",
    ) if broadcasts(base.sparkSession) else run_claims(base, runs, rules)
    days = met_days(
        vendor_rows(claims, _RUN_KEYS, rules), _RUN_KEYS, FILL_ATTRIBUTES, rules.tolerance
    )
    met = staging(linked_only(days), "met")
    linked = claims.join(
        linked_sides(met, _RUN_KEYS, rules), [*_RUN_KEYS, "dos", "datasource"], "left_semi"
    )
    key = claim_key(mode=key_mode).alias("claim_key")
    used = staging(linked.select("anchor", "paid_flag", "datasource", key), "used")
    return _both_legs(met, used, claims, runs, exclude, key_mode, rules), met, used


def integrate(
    base: DataFrame,
    runs: Sequence[int] = (PAID,),
    purged: bool = True,
    leftovers: str = "all",
    exclude: str = "all",
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
) -> DataFrame:
    """Integrated claims for the given paid flags; two flags give the union of both tables.

    ``leftovers="all"`` lists unlinked claims whatever their flag, so a claim linked in one
    run comes back unlinked in the other; ``"own_flag"`` keeps each run to its own claims.
    """
    return integrate_run(
        base, runs, purged, leftovers, exclude, key_mode, rules, staging
    ).result


def merge_final(paid: DataFrame, non_paid: DataFrame) -> DataFrame:
    """Union of two separately built integrated tables."""
    return paid.union(non_paid).distinct()


def merge_runs(
    base: DataFrame,
    purged: bool = True,
    exclude: str = "all",
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
) -> DataFrame:
    """``merge_final`` of one flag's integrated table and the other's, linked separately from a stored base.

    Both list unlinked claims whatever their flag, so most rows are in both. A claim that certainly
    occurs once and that certainly neither run has used (``_settled``) equals no other row of either
    table: the UNION takes it where it lies, if a table has it. Only the others, stored, go through
    its DISTINCT with the linked claims.
    """
    staging, flags = staging or Staging(base.sparkSession), (PAID, NON_PAID)
    runs = [_linked_run(base, (f,), exclude, key_mode, rules, staging) for f in flags]
    every_used = runs[0][2].union(runs[1][2])
    rows = _rest_rows(base, flags, "all", purged, key_mode, rules)
    apart = rules.both not in (rules.primary, rules.secondary)  # linked rows equal no others
    may = apart and broadcasts(base.sparkSession)
    parts = _settled(rows, every_used, staging) if may else None
    settled, doubtful = parts or (None, rows)
    if parts is not None:
        doubtful = staging(doubtful, "doubtful")
    tables = []
    for flag, (both, _, used) in zip(flags, runs, strict=True):
        keys = used.select("paid_flag", "claim_key")
        rest = not_in_every(doubtful, "claim_key", keys, "paid_flag", (flag,))
        tables.append(both.union(to_integrated(rest, F.col("datasource"))))
    merged = merge_final(*tables)
    if settled is None:
        return merged
    keys = every_used.select("paid_flag", "claim_key")
    sure = not_in_every(settled, "claim_key", keys, "paid_flag", flags, unlisted=True)
    return merged.union(to_integrated(sure, F.col("datasource")))


def run_pipeline(
    treatment: DataFrame,
    procedure: DataFrame,
    bridge: DataFrame,
    codes: DataFrame,
    rules: Rules = DEFAULT_RULES,
    paid_rule: str = "any",
    staging: Staging | None = None,
    **options,
) -> DataFrame:
    """From the four input tables to the final table, base and linked claims stored once.

    The session gets the run-time settings and as many partitions as the measured size of the
    inputs asks for. ``staging.drop()`` removes the stored steps when the result is saved.
    """
    spark = treatment.sparkSession
    configure(spark, input_bytes(treatment, procedure))
    staging = staging or Staging(spark)
    base = store_base(
        all_claims(treatment, procedure, bridge, codes, rules, paid_rule), staging, rules
    )
    return integrate(base, (PAID, NON_PAID), rules=rules, staging=staging, **options)


def stage_tables(
    base: DataFrame,
    paid: int = PAID,
    exclude: str = "all",
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
) -> dict[str, DataFrame]:
    """The run's intermediate tables by name, each stored: for tracing claims through the run.

    ``run_pipeline`` needs none of them; the ranked tables list every pair.
    """
    staging = staging or Staging(base.sparkSession)

    def store(name: str, df: DataFrame) -> DataFrame:
        tables[name] = staging(df, name)
        return tables[name]

    tables = {"base": base.select(*CLAIM_COLUMNS)}
    a, b, a_rest, b_rest = (
        store(f"{side}_{kind}", segment(vendor, kind == "anchor", base))
        for kind in ("anchor", "non_anchor")
        for side, vendor in (("primary", rules.primary), ("secondary", rules.secondary))
    )
    store("ranked_1", scenarios.ranked_pass_1(a, b, paid, rules))
    store("ranked_2", scenarios.ranked_pass_2(a, b, paid, exclude, key_mode, rules, staging))
    first = store(
        "scenario_1", scenarios.scenario_1(a, b, paid, exclude, key_mode, rules, staging)
    )
    third = store("scenario_3", scenarios.scenario_3(a_rest, b_rest, paid, rules))
    used_1 = store("ledger_1", scenarios.ledger_scenario_1(a, b, paid, key_mode, rules))
    used_3 = store("ledger_3", scenarios.ledger_scenario_3(a_rest, b_rest, paid, key_mode, rules))
    store("leg_scenario_1", leg_scenario_1(first, rules))
    store("leg_scenario_3", leg_scenario_3(third, used_1, key_mode, rules))
    for name in ("primary_anchor", "secondary_anchor", "primary_non_anchor",
                 "secondary_non_anchor"):
        vendor = rules.primary if name.startswith("primary") else rules.secondary
        store(f"leg_{name}", leg_rest(tables[name], vendor, used_1, used_3, key_mode))
    return tables
