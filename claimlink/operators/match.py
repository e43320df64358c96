"""Best partner per claim group, without listing the pairs.

All claims of one vendor with the same link keys and day meet all claims of the other vendor
with these keys and a day in reach. The pair order (``PAIR_ORDER``) compares columns of one
side at a time, so the first pair of such a block is made of the first claim of each side:
each side shrinks to one row per key and day (in the map tasks first). The same holds for
"first pair whose attribute is present" and, as a product of counts, for the number of pairs.

Both sides' days go through one aggregate and one sweep along the days of a key: no side is copied
into bands, and which days are linked comes out of the same sweep.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.functions import abs_days, final_value
from claimlink.operators.sweep import DAY, OTHER, OWN, in_reach, known
from claimlink.schema import (
    CLAIM_COLUMNS,
    DAY_TOLERANCE,
    DEFAULT_RULES,
    FILL_ATTRIBUTES,
    LINK_KEYS,
    OTHER_COLUMNS,
    OTHER_ORDER,
    OWN_ORDER,
    RANK_GROUP,
    Rules,
)

# A fill candidate compares like its pair: once these agree, both pairs have the same claim
# on the own side.
_FILL_ORDER = [
    "abs_date_diff",
    "claim_id",
    "other_claim_id",
    "patient_token_1",
    "provider_id",
    "out_of_pocket",
    "patient_pay",
]


def met_days(
    rows: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    tolerance: int,
    counts: bool = False,
) -> DataFrame:
    """One row per key and day of ``rows`` (key, day, own row, other row; see ``vendor_rows``).

    ``own`` is the day's first claim of the own side (NULL without one), ``is_other`` whether the
    other side has one, ``near_own`` whether the own side has one in reach, and ``partners`` the
    days of the other side in reach: the first row overall, and among those with each attribute.
    A key has at most a calendar of days and a day at most ``2 * tolerance + 1`` partners.
    """
    other = F.col(OTHER)
    measures = [F.min(OWN).alias("own"), F.min(OTHER).alias("first")]
    if counts:
        measures.append(F.count(OWN).alias("own_claims"))
    for a in attributes:
        present = other[f"other_{a}"].isNotNull()
        measures.append(F.min(F.when(present, other)).alias(f"first_{a}"))
        if counts:
            measures.append(F.count_if(present).alias(f"claims_{a}"))
    days = rows.groupBy(*keys, DAY).agg(*measures)
    partner = F.struct(
        F.date_from_unix_date(DAY).alias("other_dos"),
        "first",
        *[f"first_{a}" for a in attributes],
        *[f"claims_{a}" for a in attributes if counts],
    )
    reach = in_reach(keys, tolerance)
    return days.select(
        *keys,
        F.date_from_unix_date(DAY).alias("dos"),
        "own",
        *(["own_claims"] if counts else []),
        F.col("first").isNotNull().alias("is_other"),
        F.max(F.col("own").isNotNull()).over(reach).alias("near_own"),
        F.collect_list(F.when(F.col("first").isNotNull(), partner)).over(reach).alias("partners"),
    )


def linked_only(met: DataFrame) -> DataFrame:
    """The days of ``met_days`` with a partner in reach; only own days keep their partners."""
    has_own = F.col("own").isNotNull()
    linked = (has_own & (F.size("partners") > 0)) | (F.col("is_other") & F.col("near_own"))
    return met.filter(linked).withColumn("partners", F.when(has_own, F.col("partners")))


def linked_sides(
    met: DataFrame, keys: Sequence[str], rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """(keys, dos, datasource) of the vendors' linked days in ``linked_only(met)``."""
    own = F.col("own").isNotNull() & (F.size("partners") > 0)
    other = F.col("is_other") & F.col("near_own")
    sides = F.array_compact(
        F.array(F.when(own, F.lit(rules.primary)), F.when(other, F.lit(rules.secondary)))
    )
    return met.select(*keys, "dos", F.explode(sides).alias("datasource"))


def _blocks(met: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every own day with each day of partners in reach."""
    own = met.schema["own"].dataType.fieldNames()
    pairs = met.filter(F.col("own").isNotNull()).withColumn("partner", F.explode("partners"))
    return pairs.select(
        *keys,
        "dos",
        *[F.col(f"own.{c}").alias(c) for c in own],
        *[c for c in ("own_claims",) if c in met.columns],
        "partner.*",
        abs_days("dos", "partner.other_dos").alias("abs_date_diff"),
    )


def _own_row(keys: Sequence[str]) -> Column:
    """A claim, its columns in the order in which the first one of a day is chosen."""
    rest = [c for c in ("claim_id", *OWN_ORDER, "datasource", "paid_flag") if c not in keys]
    return F.struct(*rest)


def _other_row() -> Column:
    rest = [c for c in OTHER_ORDER if c != "other_dos"]
    return F.struct(
        *[F.col(c.removeprefix("other_")).alias(c) for c in ("other_claim_id", *rest)]
    )


def vendor_rows(
    claims: DataFrame, keys: Sequence[str], rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """The claims of both vendors as rows of a sweep; the primary vendor's are the own side."""
    vendor = F.col("datasource")
    return claims.filter(known(*keys, "dos")).select(
        *keys,
        F.unix_date("dos").alias(DAY),
        F.when(vendor == rules.primary, _own_row(keys)).alias(OWN),
        F.when(vendor == rules.secondary, _other_row()).alias(OTHER),
    )


def _side_rows(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two tables as the sides of a sweep, whatever vendor their claims name."""
    parts = []
    for df, is_own in ((a, True), (b, False)):
        parts.append(
            df.filter(known(*keys, "dos")).select(
                *keys,
                F.unix_date("dos").alias(DAY),
                F.when(F.lit(is_own), _own_row(keys)).alias(OWN),
                F.when(F.lit(not is_own), _other_row()).alias(OTHER),
            )
        )
    return parts[0].union(parts[1])


def _candidate(partner: str, order: Sequence[str], tail: Sequence[str]) -> Column:
    """Struct that compares like the pair with the given partner row."""

    def value(c: str) -> Column:
        inside = c.startswith("other_") and c != "other_dos"
        return (F.col(f"{partner}.{c}") if inside else F.col(c)).alias(c)

    return F.struct(*[value(c) for c in (*order, *tail)])


def best_matches(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str] = LINK_KEYS,
    attributes: Sequence[str] = FILL_ATTRIBUTES,
    tolerance: int = DAY_TOLERANCE,
    group: Sequence[str] = RANK_GROUP,
    ranks: bool = False,
    distinct: bool = True,
) -> DataFrame:
    """The winning pair of every group, with its missing values filled.

    Columns: ``group`` keys that are not claim columns, the claim, its partner,
    ``abs_date_diff``, ``rn`` (always 1) and, per attribute, ``augment_other_<a>`` and
    ``final_<a>``. The fill comes from the group's first pair that has the attribute, and only
    if that pair has the winner's token 1.

    ``ranks`` adds ``rn_other_<a>``, the winner's place when pairs with the attribute go first:
    1 if its own partner has it, else behind all pairs that do. ``distinct`` says whether equal
    pairs count once (as in a DISTINCT pair table) or each; it matters for these ranks only.
    """
    rows = _side_rows(a, b, keys)
    if ranks and distinct:  # a row holds all that a pair keeps of its claim
        rows = rows.distinct()
    met = met_days(rows, keys, attributes, tolerance, ranks)
    return best_of(met, keys, attributes, group, ranks)


def best_of(
    met: DataFrame,
    keys: Sequence[str] = LINK_KEYS,
    attributes: Sequence[str] = FILL_ATTRIBUTES,
    group: Sequence[str] = RANK_GROUP,
    ranks: bool = False,
) -> DataFrame:
    """``best_matches`` from the result of ``met_days``."""
    pairs = _blocks(met, keys)
    carried = [c for c in ("datasource", "paid_flag") if c not in group]
    order = [
        *(c for c in ("abs_date_diff", "claim_id", "other_claim_id", "patient_token_1")),
        *(c for c in OWN_ORDER if c not in group),
        *OTHER_ORDER,
    ]
    measures = [F.min(_candidate("first", order, carried)).alias("winner")]
    for x in attributes:
        candidate = _candidate(f"first_{x}", _FILL_ORDER, OTHER_ORDER)
        present = F.col(f"first_{x}").isNotNull()
        measures.append(F.min(F.when(present, candidate)).alias(f"fill_{x}"))
        if ranks:
            measures.append(F.sum(F.col("own_claims") * F.col(f"claims_{x}")).alias(f"pairs_{x}"))
    best = pairs.groupBy(*group).agg(*measures)

    def winner(c: str) -> Column:
        return F.col(c) if c in group else F.col(f"winner.{c}")

    same_token = {
        x: F.col(f"fill_{x}.patient_token_1") == F.col("winner.patient_token_1")
        for x in attributes
    }
    alternative = {
        x: F.when(same_token[x], F.col(f"fill_{x}.other_{x}")) for x in attributes
    }
    place = [
        F.when(winner(f"other_{x}").isNotNull(), F.lit(1).cast("bigint"))
        .otherwise(F.lit(1) + F.col(f"pairs_{x}"))
        .alias(f"rn_other_{x}")
        for x in attributes
    ]
    return best.select(
        *[c for c in group if c not in CLAIM_COLUMNS],
        *[winner(c).alias(c) for c in [*CLAIM_COLUMNS, *OTHER_COLUMNS, "abs_date_diff"]],
        F.lit(1).alias("rn"),
        *(place if ranks else []),
        *[alternative[x].alias(f"augment_other_{x}") for x in attributes],
        *[
            final_value(winner(x), winner(f"other_{x}"), alternative[x]).alias(f"final_{x}")
            for x in attributes
        ],
    )


def best_alternatives(
    a: DataFrame, b: DataFrame, attribute: str, keys: Sequence[str] = LINK_KEYS,
    tolerance: int = DAY_TOLERANCE,
) -> DataFrame:
    """The first pair of every group whose partner has the attribute.

    Partners without it cannot be in such a pair, so it is the winner among the others.
    """
    having = b.filter(F.col(attribute).isNotNull())
    return best_matches(a, having, keys, attributes=[], tolerance=tolerance).withColumn(
        f"rn_other_{attribute}", F.col("rn")
    )
