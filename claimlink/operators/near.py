"""Claims that may have a partner, told before whole claims are shuffled.

Mostly few claims have one. A claim is a hash of its link keys and a band of days, in two grids of bands:
eight bytes and its side are shuffled, and the hashes seen on both sides make a sieve (see
``operators/sieve.py``). A claim that the sieve does not know has no partner. The others are more
than those linked (bands are wider than the reach, hashes and sieve may err), so the exact work still
follows; it is done on them alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.operators.sieve import MAX_BYTES, sieve_of
from claimlink.operators.sweep import known
from claimlink.session import broadcasts
from claimlink.sources import Staging

_HASHES = ["_near_0", "_near_1"]
_FOUND = ["_found_0", "_found_1"]
_OWN_SIDE, _OTHER_SIDE = 1, 2


def _hashes(keys: Sequence[str], tolerance: int) -> list[Column]:
    """A claim in its band of either grid.

    Bands are twice the tolerance wide and the grids half a band apart, so no two days in reach are cut
    apart by both.
    """
    width, day = max(2 * tolerance, 1), F.unix_date("dos")
    return [
        F.xxhash64(*keys, F.lit(grid), F.floor((day + shift) / width)).alias(name)
        for grid, (name, shift) in enumerate(zip(_HASHES, (0, tolerance), strict=True))
    ]


def near(
    claims: DataFrame,
    keys: Sequence[str],
    own: Column,
    other: Column,
    tolerance: int,
    staging: Staging,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """The claims without most of those that have no partner on the other side; no linked one is lost.

    ``own`` and ``other`` say which side a claim is on. ``claims`` is read twice and should be a stored
    table. Sessions that turn broadcasts off, and lists too long for a sieve, keep all claims.
    """
    if not broadcasts(claims.sparkSession):
        return claims
    candidates = claims.filter(known(*keys, "dos") & (own | other))
    side = F.when(own, F.lit(_OWN_SIDE)).otherwise(F.lit(_OTHER_SIDE))
    bands = candidates.select(F.explode(F.array(*_hashes(keys, tolerance))).alias("_near"),
                              side.alias("_side"))
    sides = bands.groupBy("_near").agg(F.bit_or("_side").alias("_sides"))
    met = sides.filter(F.col("_sides") == _OWN_SIDE | _OTHER_SIDE).select("_near")
    sieve = sieve_of(staging(met, "near_bands"), staging, max_bytes)
    if sieve is None:
        return claims
    rows = candidates.select("*", *_hashes(keys, tolerance))
    for found, name in zip(_FOUND, _HASHES, strict=True):
        rows = sieve.marked(rows, [name], found)
    return rows.filter(F.col(_FOUND[0]) | F.col(_FOUND[1])).select(*claims.columns)


def near_sides(
    own: DataFrame, other: DataFrame, keys: Sequence[str], tolerance: int, staging: Staging
) -> tuple[DataFrame, DataFrame]:
    """``near`` for two tables of claims as the sides, whatever vendor they name; what is left is stored."""
    if not broadcasts(own.sparkSession):
        return own, other
    sides = own.withColumn("_is_own", F.lit(True)).unionByName(
        other.withColumn("_is_own", F.lit(False))
    )
    is_own = F.col("_is_own")
    kept = staging(near(sides, keys, is_own, ~is_own, tolerance, staging), "near")
    return kept.filter(is_own).select(*own.columns), kept.filter(~is_own).select(*own.columns)
