"""Invertible sketches: which keys have other numbers of rows in one table than in another.

Counts say that two tables differ; a sketch says where, without shuffling the keys. Every row adds its
key's digest to three cells, one in each third of a small table, with sign plus for the one side and
minus for the other. What both sides hold alike cancels out. A cell in which one key is left gives
that key's digest (the sums divided by the count) and a checksum tells such cells from others; taking
the key out of its two other cells leaves more cells with a single key, until all are empty. The cells
are sums, so they are combined in the map tasks, and what reaches the driver is ``3 * CELLS`` rows of
seven numbers whatever the tables hold.

The digests found select the rows that are counted by key afterwards, so counts are exact. If more
keys differ than the cells can tell apart (some 2.4 times ``CELLS``), cells stay filled, and all keys
are counted instead, which shuffles them. Two different keys with one 64-bit digest are taken for one
key only as long as their differences cancel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 4096  # in each third; a power of two, at most 2**21
_BITS = 21  # of a part of a digest: sums of 2**42 parts fit a long
_PART = (1 << _BITS) - 1
_HALF = (1 << 16) - 1
_DIGEST = "_digest"
_SUMS = ("n", "p0", "p1", "p2", "c0", "c1")


def digest(keys: Sequence[str]) -> Column:
    """64 bits of a key; NULL parts count, as they would in a GROUP BY."""
    return F.xxhash64(*[part for k in keys for part in (F.col(k), F.col(k).isNull())])


def _parts(d: int) -> tuple[int, int, int]:
    d &= (1 << 64) - 1
    return d >> 2 * _BITS, d >> _BITS & _PART, d & _PART


def cells_of(before: DataFrame, after: DataFrame, keys: Sequence[str], cells: int) -> DataFrame:
    """The filled cells of both tables' difference: number and six sums."""
    signed = before.select(digest(keys).alias("d"), F.lit(1).alias("sign")).unionAll(
        after.select(digest(keys).alias("d"), F.lit(-1).alias("sign"))
    )
    parts = [
        F.shiftrightunsigned("d", 2 * _BITS),
        F.shiftrightunsigned("d", _BITS).bitwiseAND(F.lit(_PART)),
        F.col("d").bitwiseAND(F.lit(_PART)),
    ]
    named = signed.select(
        "sign",
        *[p.alias(f"p{j}") for j, p in enumerate(parts)],
        F.crc32(F.col("d").cast("string").cast("binary")).alias("crc"),
    )
    places = F.array(
        *[F.col(f"p{j}") % cells + F.lit(j * cells).cast("bigint") for j in range(len(parts))]
    )
    values = {
        "n": F.lit(1), "p0": F.col("p0"), "p1": F.col("p1"), "p2": F.col("p2"),
        "c0": F.col("crc").bitwiseAND(F.lit(_HALF)), "c1": F.shiftright("crc", 16),
    }
    sums = [F.sum(F.col("sign") * values[s]).alias(s) for s in _SUMS]
    placed = named.withColumn("cell", F.explode(places))
    empty = " AND ".join(f"{s} = 0" for s in _SUMS)
    return placed.groupBy("cell").agg(*sums).filter(f"NOT ({empty})")


def peel(filled: Iterable[Sequence[int]], cells: int) -> set[int] | None:
    """Digests (signed) of all keys left in the cells, or None if some cannot be told apart."""
    table = {row[0]: list(row[1:]) for row in filled}
    found: set[int] = set()
    todo = list(table)
    while todo:
        sums = table.get(todo.pop())
        if sums is None or sums[0] == 0 or any(s % sums[0] for s in sums):
            continue
        n, *one = sums
        p0, p1, p2, c0, c1 = (s // n for s in one)
        if not (0 <= p0 <= 2 * _PART + 1 and 0 <= p1 <= _PART and 0 <= p2 <= _PART):
            continue
        d = p0 << 2 * _BITS | p1 << _BITS | p2
        d -= (d >> 63) << 64
        if zlib.crc32(str(d).encode()) != c1 << 16 | c0:
            continue
        found.add(d)
        for j, part in enumerate(_parts(d)):
            place = j * cells + part % cells
            left = [a - n * b for a, b in zip(
                table.get(place, [0] * len(_SUMS)), (1, p0, p1, p2, c0, c1), strict=True
            )]
            if any(left):
                table[place] = left
                todo.append(place)
            else:
                table.pop(place, None)
    return None if table else found


def _counted(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = before.select(*keys, one.alias("b"), none.alias("a")).unionAll(
        after.select(*keys, none.alias("b"), one.alias("a"))
    )
    return (
        both.groupBy(*keys)
        .agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"))
        .filter("rows_before <> rows_after")
    )


def differing(
    before: DataFrame, after: DataFrame, keys: Sequence[str], cells: int = CELLS
) -> DataFrame:
    """Keys whose number of rows differs, with ``rows_before`` and ``rows_after``.

    Both tables are read for the sketch at once, and again when the result is asked for; tables that
    are costly to make should be stored. Key columns must have the same types on both sides. NULL is
    a key value like any other.
    """
    before, after = before.select(*keys), after.select(*keys)
    found = peel(cells_of(before, after, keys, cells).collect(), cells)
    if found is None:
        return _counted(before, after, keys)
    listed = before.sparkSession.createDataFrame([(d,) for d in sorted(found)], f"{_DIGEST} bigint")

    def of(df: DataFrame) -> DataFrame:
        hashed = df.withColumn(_DIGEST, digest(keys))
        return hashed.join(F.broadcast(listed), _DIGEST, "left_semi").select(*keys)

    return _counted(of(before), of(after), keys)
