"""Ranks of all pairs inside their group.

Five ranks are asked for: by date difference, and by "attribute present, then date
difference" for four attributes. One sorted pass gives all of them: running along the pair
order, a pair with the attribute stands behind the earlier pairs that have it; a pair without
it stands behind all that have it and the earlier ones that do not.

A group (patient, code, day) with more than ``HOT_PAIRS`` pairs is not one task's work. Its pairs
are stored, dealt into ranges of the pair order and stored again: a range is one task's share
wherever the order cuts, whatever the ids look like. Places inside a range are shifted by the
sizes of the group's ranges before it. Which groups are hot is known beforehand from products of
per-day counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlink.functions import presence
from claimlink.operators.link import (
    CELL_SIDE,
    crowded_keys,
    drop_listed,
    other_side,
    pairs_in_reach,
    with_flag,
)
from claimlink.operators.sweep import sweep
from claimlink.schema import (
    CLAIM_COLUMNS,
    DAY_TOLERANCE,
    FILL_ATTRIBUTES,
    LINK_KEYS,
    OTHER_COLUMNS,
    PAIR_ORDER,
    RANK_GROUP,
)
from claimlink.sources import Staging

HOT_PAIRS = 1_000_000

_ORDER = [c for c in PAIR_ORDER if c not in RANK_GROUP]


def _attribute_rank(x: str, rn: Column, having: Column, all_having: Column) -> Column:
    return (
        F.when(F.col(f"other_{x}").isNotNull(), having)
        .otherwise(all_having + rn - having)
        .alias(f"rn_other_{x}")
    )


def _rank_in_windows(pairs: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """One sort of every group."""
    group = Window.partitionBy(*RANK_GROUP)
    along = group.orderBy(*_ORDER)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = pairs.select(
        "*",
        F.row_number().over(along).alias("rn"),
        *[F.sum(presence(f"other_{x}")).over(so_far).alias(f"_with_{x}") for x in attributes],
        *[F.sum(presence(f"other_{x}")).over(group).alias(f"_all_{x}") for x in attributes],
    )
    return counted.select(
        *CLAIM_COLUMNS,
        *OTHER_COLUMNS,
        "abs_date_diff",
        F.col("rn").cast("bigint").alias("rn"),
        *[
            _attribute_rank(x, F.col("rn"), F.col(f"_with_{x}"), F.col(f"_all_{x}"))
            for x in attributes
        ],
    )


def place_in_ranges(pairs: DataFrame, staging: Staging) -> DataFrame:
    """The pairs stored in ranges of (group, pair order), with ``_range`` and ``_place`` in it.

    Pairs are stored before they are dealt out, and so is the outcome: the cuts come from a
    sample, so a second run could cut elsewhere.
    """
    order = [*RANK_GROUP, *_ORDER]
    stored = staging(pairs, "hot_pairs")
    tasks = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = staging(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    return placed.select(
        "*",
        F.shiftright("_at", 33).alias("_range"),
        F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place"),
    )


def _rank_in_ranges(
    pairs: DataFrame, attributes: Sequence[str], staging: Staging
) -> DataFrame:
    placed = place_in_ranges(pairs, staging)
    piece = [*RANK_GROUP, "_range"]
    sizes = placed.groupBy(*piece).agg(
        F.count(F.lit(1)).alias("pairs"),
        F.min("_place").alias("_first"),
        *[F.sum(presence(f"other_{x}")).alias(x) for x in attributes],
    )
    group = Window.partitionBy(*RANK_GROUP)  # one row per range of the group
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)

    def before(c: str) -> Column:
        return F.coalesce(F.sum(c).over(earlier), F.lit(0))

    offsets = sizes.select(
        *piece,
        "_first",
        before("pairs").alias("_before"),
        *[before(x).alias(f"_before_{x}") for x in attributes],
        *[F.sum(x).over(group).alias(f"_all_{x}") for x in attributes],
    )
    inside = Window.partitionBy(*piece).orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = placed.select(
        "*", *[F.sum(presence(f"other_{x}")).over(inside).alias(f"_with_{x}") for x in attributes]
    )
    rn = F.col("_before") + F.col("_place") - F.col("_first") + 1
    return counted.join(offsets, piece).select(
        *CLAIM_COLUMNS,
        *OTHER_COLUMNS,
        "abs_date_diff",
        rn.alias("rn"),
        *[
            _attribute_rank(
                x, rn, F.col(f"_before_{x}") + F.col(f"_with_{x}"), F.col(f"_all_{x}")
            )
            for x in attributes
        ],
    )


def _hot_groups(
    own: DataFrame, other: DataFrame, keys: Sequence[str], tolerance: int, staging: Staging,
    hot_pairs: int,
) -> DataFrame | None:
    """Groups with more pairs than ``hot_pairs``, from counts per key and day."""
    counts = sweep(
        own.groupBy(*keys, "dos").agg(F.count(F.lit(1)).alias("own_claims")),
        other.groupBy(*keys, "other_dos").agg(F.count(F.lit(1)).alias("other_claims")),
        keys,
        tolerance,
    )
    hot = staging(
        counts.groupBy(*RANK_GROUP)
        .agg(F.sum(F.col("own_claims") * F.col("other_claims")).alias("pairs"))
        .filter(F.col("pairs") > hot_pairs)
        .select(*RANK_GROUP),
        "hot_groups",
    )
    return None if hot.isEmpty() else hot


def rank_links(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str] = LINK_KEYS,
    paid: int = 1,
    tolerance: int = DAY_TOLERANCE,
    attributes: Sequence[str] = FILL_ATTRIBUTES,
    distinct: bool = True,
    exclude: DataFrame | None = None,
    key_mode: str = "concat",
    staging: Staging | None = None,
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """Pairs of ``link`` with ``rn`` and ``rn_other_<attribute>`` inside (token 2, code, dos)."""
    staging = staging or Staging(a.sparkSession)
    own, other = with_flag(a, paid).select(*CLAIM_COLUMNS), other_side(with_flag(b, paid), keys)
    # Patient and code alone are coarser than the link keys and than a group without its day: where
    # they are not crowded, no key is, and a group has a few times ``hot_pairs`` pairs at most.
    side = min(CELL_SIDE, math.isqrt(hot_pairs))
    coarse = [c for c in RANK_GROUP if c != "dos"]
    crowded = crowded_keys(own, other, coarse, tolerance, staging, side)
    own = drop_listed(own, exclude, key_mode)
    if distinct:
        own, other = own.distinct(), other.distinct()
    if crowded is None:
        return _rank_in_windows(sweep(own, other, keys, tolerance), attributes)
    crowded = crowded_keys(own, other, keys, tolerance, staging)
    hot = _hot_groups(own, other, keys, tolerance, staging, hot_pairs)

    def pairs(own: DataFrame) -> DataFrame:
        return pairs_in_reach(own, other, keys, tolerance, staging, crowded)

    if hot is None:
        return _rank_in_windows(pairs(own), attributes)
    # A group's pairs all come from own claims of that group.
    ordinary = own.join(hot, RANK_GROUP, "left_anti").select(*own.columns)
    many = own.join(hot, RANK_GROUP, "left_semi").select(*own.columns)
    return _rank_in_windows(pairs(ordinary), attributes).union(
        _rank_in_ranges(pairs(many), attributes, staging)
    )


def winners(ranked: DataFrame) -> DataFrame:
    """Best pair of every group of a ranked table."""
    return ranked.filter(F.col("rn") == 1)


def best_alternative(ranked: DataFrame, attribute: str) -> DataFrame:
    """Best pair of every group that has the attribute."""
    return ranked.filter(
        (F.col(f"rn_other_{attribute}") == 1) & F.col(f"other_{attribute}").isNotNull()
    )
