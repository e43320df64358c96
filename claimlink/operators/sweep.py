"""Pairs within a band of days by a sweep over both sides.

The two sides are united under a tag, shuffled once by the link keys and sorted by day. A range moving
along the days then holds, for every row, the partners in reach: pairs come out of it without a join,
and no side is copied into neighbouring bands of days.

A key is one task's work, so its claims must be few: ``operators/link.py`` tells crowded keys, whose
days hold too many, and cuts their bands into cells instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from claimlink.functions import abs_days

OWN, OTHER, DAY = "_own", "_other", "_day"


def known(*columns: str) -> Column:
    """Rows without a key or a day have no partner."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def in_reach(keys: Sequence[str], tolerance: int) -> WindowSpec:
    """The rows of a key at most ``tolerance`` days away, on either side."""
    return Window.partitionBy(*keys).orderBy(DAY).rangeBetween(-tolerance, tolerance)


def tagged(own: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides as (keys, day, own row or NULL, other row or NULL)."""
    sides = ((own, "dos"), (other, "other_dos"))
    rows = [F.struct(*[c for c in df.columns if c not in keys]) for df, _ in sides]
    kinds = [df.select(row.alias("row")).schema["row"].dataType
             for (df, _), row in zip(sides, rows, strict=True)]
    parts = []
    for at, (df, day) in enumerate(sides):
        cells = [F.lit(None).cast(kind) for kind in kinds]
        cells[at] = rows[at]
        parts.append(
            df.filter(known(*keys, day)).select(
                *keys, F.unix_date(day).alias(DAY), cells[0].alias(OWN), cells[1].alias(OTHER)
            )
        )
    return parts[0].union(parts[1])


def sweep(
    own: DataFrame, other: DataFrame, keys: Sequence[str], tolerance: int
) -> DataFrame:
    """Inner join on ``keys`` and at most ``tolerance`` days between ``dos`` and ``other_dos``.

    The columns are those of ``own``, the others of ``other``, and ``abs_date_diff``.
    """
    reached = F.collect_list(OTHER).over(in_reach(keys, tolerance))
    met = tagged(own, other, keys).select(*keys, OWN, reached.alias("_others"))
    pairs = met.filter(F.col(OWN).isNotNull()).select(
        *keys, OWN, F.explode("_others").alias(OTHER)
    )
    partner = [c for c in other.columns if c not in keys]
    return pairs.select(
        *[F.col(c) if c in keys else F.col(f"{OWN}.{c}") for c in own.columns],
        *[F.col(f"{OTHER}.{c}") for c in partner],
        abs_days(f"{OWN}.dos", f"{OTHER}.other_dos").alias("abs_date_diff"),
    )
