"""Linking two vendors on equal keys and a band of days.

``link`` lists the pairs. ``linked_claims`` only says which claims have a partner: it works on
one row per key and day, so its cost does not grow with the number of pairs.

Pairs come from a sweep over the days of a key (``operators/sweep.py``). Keys with more claims than
``CELL_SIDE`` in one band of days are crowded: they are told beforehand by a small aggregate, their
bands are cut into cells of bounded size, and the cells are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlink.functions import abs_days, claim_key, presence_flags
from claimlink.operators.antijoin import not_in
from claimlink.operators.near import near, near_sides
from claimlink.operators.sweep import known, sweep
from claimlink.schema import (
    CLAIM_COLUMNS,
    DAY_TOLERANCE,
    DEFAULT_RULES,
    EXACT_KEYS,
    FILL_ATTRIBUTES,
    LINK_KEYS,
    OTHER_COLUMNS,
    Rules,
)
from claimlink.sources import Staging

_ROW = "_row"
CELL_SIDE = 1000  # claims of either side in one cell of a band: at most a million pairs a task


def with_flag(claims: DataFrame, paid: int | None) -> DataFrame:
    """Claims of one paid flag; ``None`` keeps both, to be kept apart by a ``paid_flag`` key."""
    return claims if paid is None else claims.filter(F.col("paid_flag") == paid)


def drop_listed(
    claims: DataFrame,
    ledger: DataFrame | None,
    key_mode: str = "concat",
    by: str | None = None,
    values: Sequence[int] | None = None,
) -> DataFrame:
    """Claims whose key is not in the ledger; no ledger keeps all."""
    if ledger is None:
        return claims
    keyed = claims.withColumn("claim_key", claim_key(mode=key_mode))
    return not_in(keyed, "claim_key", ledger, by, values).drop("claim_key")


def other_side(claims: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The partner's part of a pair: the link keys and the columns a pair keeps of it."""
    return claims.select(
        *keys, *[F.col(c.removeprefix("other_")).alias(c) for c in OTHER_COLUMNS]
    )


def _in_bands(
    own: DataFrame, other: DataFrame, tolerance: int
) -> tuple[DataFrame, DataFrame]:
    """Days cut into bands of the tolerance's width, the other side standing in three of them.

    Two days in reach of each other lie in the same or in neighbouring bands, so the band is an
    equality key: a key with a long history is spread over many tasks, and a pair meets once.
    """
    width = max(tolerance, 1)
    other_band = F.floor(F.unix_date("other_dos") / width)
    return (
        own.withColumn("_band", F.floor(F.unix_date("dos") / width)),
        other.withColumn(
            "_band", F.explode(F.array(other_band - 1, other_band, other_band + 1))
        ),
    )


def crowded_keys(
    own: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    tolerance: int,
    staging: Staging,
    side: int = CELL_SIDE,
) -> DataFrame | None:
    """Keys with more than ``side`` claims of either side in one band of days.

    Counted and stored; equal claims count each, so nothing need be made distinct for it. All other
    keys have at most a few times ``side`` partners in reach of a claim, and at most a calendar
    of bands.
    """
    width = max(tolerance, 1)

    def banded(df: DataFrame, day: str, own_side: bool) -> DataFrame:
        return df.filter(known(*keys, day)).select(
            *keys,
            F.floor(F.unix_date(day) / width).alias("_band"),
            F.lit(own_side).alias("_is_own"),
        )

    counts = (
        banded(own, "dos", True)
        .union(banded(other, "other_dos", False))
        .groupBy(*keys, "_band")
        .agg(F.count_if("_is_own").alias("own"), F.count_if(~F.col("_is_own")).alias("other"))
    )
    crowded = staging(
        counts.filter((F.col("own") > side) | (F.col("other") > side)).select(*keys).distinct(),
        "crowded",
    )
    return None if crowded.isEmpty() else crowded


def pairs_in_reach(
    own: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    tolerance: int,
    staging: Staging,
    crowded: DataFrame | None,
    side: int = CELL_SIDE,
) -> DataFrame:
    """``sweep``, with the pairs of the ``crowded_keys`` made cell by cell."""
    if crowded is None:
        return sweep(own, other, keys, tolerance)
    few = [df.join(crowded, list(keys), "left_anti") for df in (own, other)]
    many = []
    for name, df in (("crowded_own", own), ("crowded_other", other)):
        part = df.join(crowded, list(keys), "left_semi").select(*df.columns)
        # Stored with a number: equal rows then go to different cells, always the same ones.
        many.append(staging(part.withColumn(_ROW, F.monotonically_increasing_id()), name))
    hot = hot_bands(*many, keys, tolerance, staging, side)
    swept = sweep(*few, keys, tolerance)
    return swept.union(band_join(*many, keys, tolerance, hot).select(*swept.columns))


def hot_bands(
    own: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    tolerance: int,
    staging: Staging,
    side: int = CELL_SIDE,
) -> DataFrame | None:
    """Bands with more pairs than a task should make, and into how many cells each side is cut.

    Counted and stored: the count per key and band is a small aggregate, the hot ones are few.
    """
    own, other = _in_bands(own, other, tolerance)
    at = [*keys, "_band"]
    counts = (
        own.groupBy(*at).agg(F.count(F.lit(1)).alias("own"))
        .join(other.groupBy(*at).agg(F.count(F.lit(1)).alias("other")), at)
        .filter(F.col("own") * F.col("other") > side * side)
    )
    hot = staging(
        counts.select(
            *at,
            F.ceil(F.col("own") / side).alias("own_cells"),
            F.ceil(F.col("other") / side).alias("other_cells"),
        ),
        "hot_bands",
    )
    return None if hot.isEmpty() else hot


def band_join(
    own: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    tolerance: int,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner join on ``keys`` and at most ``tolerance`` days between ``dos`` and ``other_dos``.

    ``hot`` (see ``hot_bands``) cuts the named bands into a grid of cells: a claim is in one row
    or column of cells by hash, of its number if it has one, and meets all cells across, so the
    pairs of a hot patient, code and day are made by many tasks.
    """
    own, other = _in_bands(own, other, tolerance)
    at = [*keys, "_band"]
    if hot is not None:
        cells = {"_own_cell": "own_cells", "_other_cell": "other_cells"}

        def cut(df: DataFrame, placed: str, across: str) -> DataFrame:
            row = F.xxhash64(*([_ROW] if _ROW in df.columns else df.columns))
            number = {c: F.coalesce(F.col(n), F.lit(1)) for c, n in cells.items()}
            return (
                df.join(hot, at, "left")
                .withColumn(placed, F.pmod(row, number[placed]))
                .withColumn(across, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                         number[across] - 1)))
                .drop(*cells.values())
            )

        own = cut(own, "_own_cell", "_other_cell")
        other = cut(other, "_other_cell", "_own_cell")
        at = [*at, *cells]
    return (
        own.join(other, at)
        .withColumn("abs_date_diff", abs_days("dos", "other_dos"))
        .filter(F.col("abs_date_diff") <= tolerance)
        .drop("_band", "_own_cell", "_other_cell", _ROW)
    )


def link(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str] = LINK_KEYS,
    paid: int = 1,
    tolerance: int = DAY_TOLERANCE,
    distinct: bool = True,
    exclude: DataFrame | None = None,
    key_mode: str = "concat",
    staging: Staging | None = None,
) -> DataFrame:
    """All pairs (claim of ``a``, claim of ``b``); ``exclude`` lists keys of ``a`` to leave out.

    A pair is a claim and six columns of its partner. DISTINCT over pairs equals DISTINCT on
    each side before the join, where copies shrink in the map tasks.
    """
    staging = staging or Staging(a.sparkSession)
    sides = (with_flag(df, paid).select(*CLAIM_COLUMNS) for df in (a, b))
    own, other = near_sides(*sides, keys, tolerance, staging)
    other = other_side(other, keys)
    crowded = crowded_keys(own, other, keys, tolerance, staging)
    own = drop_listed(own, exclude, key_mode)
    if distinct:
        own, other = own.distinct(), other.distinct()
    pairs = pairs_in_reach(own, other, keys, tolerance, staging, crowded)
    return pairs.select(*CLAIM_COLUMNS, *OTHER_COLUMNS, "abs_date_diff")


def anchor_pairs(
    a: DataFrame,
    b: DataFrame,
    paid: int = 1,
    exclude: DataFrame | None = None,
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Distinct anchor pairs with provenance and presence flags (31 columns)."""
    pairs = link(
        a, b, LINK_KEYS, paid, rules.tolerance, exclude=exclude, key_mode=key_mode
    )
    return pairs.select(
        F.lit(rules.both).alias("data_source"),
        *CLAIM_COLUMNS,
        *OTHER_COLUMNS,
        *presence_flags(FILL_ATTRIBUTES),
        "abs_date_diff",
    )


def exact_pairs(
    a: DataFrame, b: DataFrame, paid: int = 1, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Non-anchor pairs, which must also agree on provider and both amounts (27 columns)."""
    pairs = link(a, b, EXACT_KEYS, paid, rules.tolerance, distinct=False)
    return pairs.select(
        *CLAIM_COLUMNS, *presence_flags(["days_supply"]), *OTHER_COLUMNS, "abs_date_diff"
    )


def linked_days(
    claims: DataFrame, keys: Sequence[str], rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """(keys, dos, datasource) for which the other vendor has a claim within the tolerance.

    Claims collapse to one row per key and day, map-side first; the window then holds at most
    one row per calendar day.
    """
    days = (
        claims.filter(known(*keys, "dos"))
        .groupBy(*keys, "dos")
        .agg(
            F.max(F.col("datasource") == rules.primary).alias("in_primary"),
            F.max(F.col("datasource") == rules.secondary).alias("in_secondary"),
        )
    )
    reach = (
        Window.partitionBy(*keys).orderBy("day").rangeBetween(-rules.tolerance, rules.tolerance)
    )
    near = days.withColumn("day", F.unix_date("dos")).select(
        "*",
        F.max("in_primary").over(reach).alias("near_primary"),
        F.max("in_secondary").over(reach).alias("near_secondary"),
    )
    sides = F.array_compact(
        F.array(
            F.when(F.col("in_primary") & F.col("near_secondary"), F.lit(rules.primary)),
            F.when(F.col("in_secondary") & F.col("near_primary"), F.lit(rules.secondary)),
        )
    )
    return near.select(*keys, "dos", F.explode(sides).alias("datasource"))


def linked_claims(
    claims: DataFrame, keys: Sequence[str], rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Claims of either vendor that have at least one partner at the other one."""
    days = linked_days(claims, keys, rules)
    return claims.join(days, [*keys, "dos", "datasource"], "left_semi")


def ledger(
    claims: DataFrame,
    keys: Sequence[str],
    paid: int = 1,
    key_mode: str = "concat",
    rules: Rules = DEFAULT_RULES,
    staging: Staging | None = None,
) -> DataFrame:
    """Keys of every linked claim on both sides, whether or not its pair wins."""
    staging = staging or Staging(claims.sparkSession)
    vendor = F.col("datasource")
    claims = near(
        with_flag(claims, paid),
        keys,
        vendor == rules.primary,
        vendor == rules.secondary,
        rules.tolerance,
        staging,
    )
    linked = linked_claims(claims, keys, rules)
    return linked.select(claim_key(mode=key_mode).alias("claim_key")).distinct()
