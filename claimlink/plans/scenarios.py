"""Linked claims: anchors (scenario 1) and exact non-anchor matches (scenario 3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlink.functions import claim_key, presence_flags
from claimlink.operators.link import drop_listed, ledger, linked_claims, with_flag
from claimlink.operators.match import best_matches
from claimlink.operators.near import near_sides
from claimlink.operators.rank import rank_links
from claimlink.schema import (
    CLAIM_COLUMNS,
    DEFAULT_RULES,
    EXACT_KEYS,
    FILL_ATTRIBUTES,
    LINK_KEYS,
    OTHER_COLUMNS,
    Rules,
)
from claimlink.sources import Staging



def _sides(
    a: DataFrame, b: DataFrame, paid: int, keys: Sequence[str], rules: Rules, staging: Staging | None
) -> tuple[DataFrame, DataFrame]:
    """Claims of the flag that may have a partner on the other side."""
    own, other = (with_flag(df, paid).select(*CLAIM_COLUMNS) for df in (a, b))
    staging = staging or Staging(a.sparkSession)
    return near_sides(own, other, keys, rules.tolerance, staging)


_RANKS = ["rn", *[f"rn_other_{a}" for a in FILL_ATTRIBUTES]]


def _provenance(rules: Rules):
    return F.lit(rules.both).alias("data_source")


def pass_2_ledger(
    a: DataFrame,
    b: DataFrame,
    paid: int = 1,
    exclude: str = "all",
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Keys of ``b`` the reverse pass leaves out.

    ``all``: every claim of ``b`` linked in the first pass. ``winners``: only those in a
    winning pair.
    """
    if exclude == "all":
        linked = linked_claims(with_flag(a.union(b), paid), LINK_KEYS, rules)
        return (
            linked.filter(F.col("datasource") == rules.secondary)
            .select(claim_key(mode=key_mode).alias("claim_key"))
            .distinct()
        )
    if exclude == "winners":
        own, other = _sides(a, b, paid, LINK_KEYS, rules, None)
        best = best_matches(own, other, tolerance=rules.tolerance, attributes=[])
        return best.select(claim_key("other_claim_id", "code", key_mode).alias("claim_key"))
    raise ValueError(f"unknown exclusion: {exclude!r}")


def ranked_pass_1(
    a: DataFrame, b: DataFrame, paid: int = 1, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """All anchor pairs, primary claim first, with five ranks (36 columns)."""
    return _ranked(rank_links(a, b, LINK_KEYS, paid, rules.tolerance), rules)


def ranked_pass_2(
    a: DataFrame,
    b: DataFrame,
    paid: int = 1,
    exclude: str = "all",
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
) -> DataFrame:
    """The same seen from the secondary vendor, for its claims not yet linked.

    With ``exclude="all"`` nothing is left: the link is symmetric, so a claim that finds a
    partner here was already part of a first-pass pair.
    """
    staging = staging or Staging(a.sparkSession)
    listed = staging(pass_2_ledger(a, b, paid, exclude, key_mode, rules), "listed")
    pairs = rank_links(
        b, a, LINK_KEYS, paid, rules.tolerance, exclude=listed, key_mode=key_mode,
        staging=staging,
    )
    return _ranked(pairs, rules)


def _ranked(pairs: DataFrame, rules: Rules) -> DataFrame:
    return pairs.select(
        _provenance(rules),
        *CLAIM_COLUMNS,
        *OTHER_COLUMNS,
        *presence_flags(FILL_ATTRIBUTES),
        "abs_date_diff",
        *_RANKS,
    )


def matched_pass_1(
    a: DataFrame,
    b: DataFrame,
    paid: int = 1,
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
) -> DataFrame:
    """Winning anchor pair of every group with ranks and filled values (44 columns)."""
    own, other = _sides(a, b, paid, LINK_KEYS, rules, staging)
    best = best_matches(own, other, LINK_KEYS, tolerance=rules.tolerance, ranks=True)
    return _matched(best, rules)


def matched_pass_2(
    a: DataFrame,
    b: DataFrame,
    paid: int = 1,
    exclude: str = "all",
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
) -> DataFrame:
    """Winning pairs of the reverse pass (44 columns); the list of used keys is stored."""
    staging = staging or Staging(a.sparkSession)
    listed = staging(pass_2_ledger(a, b, paid, exclude, key_mode, rules), "listed")
    own, other = _sides(b, a, paid, LINK_KEYS, rules, staging)
    rest = drop_listed(own, listed, key_mode)
    best = best_matches(rest, other, LINK_KEYS, tolerance=rules.tolerance, ranks=True)
    return _matched(best, rules)


def _matched(best: DataFrame, rules: Rules) -> DataFrame:
    return best.select(
        _provenance(rules),
        *CLAIM_COLUMNS,
        *OTHER_COLUMNS,
        *presence_flags(FILL_ATTRIBUTES),
        "abs_date_diff",
        *_RANKS,
        *[f"augment_other_{x}" for x in FILL_ATTRIBUTES],
        *[f"final_{x}" for x in FILL_ATTRIBUTES],
    )


def consolidated(matched: DataFrame) -> DataFrame:
    """Winning pairs before filling (36 columns)."""
    return matched.drop(
        *[f"augment_other_{x}" for x in FILL_ATTRIBUTES],
        *[f"final_{x}" for x in FILL_ATTRIBUTES],
    )


def scenario_1(
    a: DataFrame,
    b: DataFrame,
    paid: int = 1,
    exclude: str = "all",
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
) -> DataFrame:
    """Anchor result of both passes, united by position (44 columns).

    The reverse pass is empty with ``exclude="all"`` (see ``ranked_pass_2``) and is then not
    run. Otherwise its rows belong to the other vendor, and a pass has one row per group, so
    the union holds no duplicates.
    """
    first = matched_pass_1(a, b, paid, rules, staging)
    if exclude == "all":
        return first
    return first.union(matched_pass_2(a, b, paid, exclude, key_mode, rules, staging))


def scenario_3(
    a: DataFrame, b: DataFrame, paid: int = 1, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Best exact non-anchor pair of every group, days supply filled (30 columns)."""
    own, other = _sides(a, b, paid, EXACT_KEYS, rules, None)
    best = best_matches(
        own,
        other,
        EXACT_KEYS,
        attributes=["days_supply"],
        tolerance=rules.tolerance,
        ranks=True,
        distinct=False,
    )
    return best.select(
        *CLAIM_COLUMNS,
        *presence_flags(["days_supply"]),
        *OTHER_COLUMNS,
        "abs_date_diff",
        "rn",
        "rn_other_days_supply",
        "final_days_supply",
    )


def ledger_scenario_1(
    a: DataFrame,
    b: DataFrame,
    paid: int = 1,
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Keys of all linked anchor claims.

    The reverse pass adds none: its pairs are first-pass pairs seen from the other side.
    """
    return ledger(a.union(b), LINK_KEYS, paid, key_mode, rules)


def ledger_scenario_3(
    a: DataFrame,
    b: DataFrame,
    paid: int = 1,
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Keys of all exactly linked non-anchor claims."""
    return ledger(a.union(b), EXACT_KEYS, paid, key_mode, rules)
