"""Bloom filters of key lists, so that rows certainly not listed need no shuffle.

The filter is a small table: one row per block of 256 bits, in four long words. A key's hash names its
block and eight bits in it, one per half word. Building it is a hash aggregate (``bit_or`` per block,
combined in the map tasks); testing it is a broadcast join on the block number whose condition
compares bits, so both stay in generated code. A key that was put in is always found; another one is
found by mistake with the probability ``false_positives`` says.

A list whose filter would be larger than ``MAX_BYTES`` gets fewer bits per key, and none at all below
``LEAST_BITS``: then too many rows would pass by mistake, and the caller shuffles instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.sources import Staging

MAX_BYTES = 64 * 1024 * 1024
BITS_PER_KEY = 12
LEAST_BITS = 5
_BLOCK_BITS = 256
_BLOCK_BYTES = 48  # of a row: block number and four words
_WORDS = 4
_BLOCK = "_sieve_block"
_LOW = (1 << 31) - 1
# Odd multipliers below 2^31, one per half word: what they leave in the bits 26 to 30 of a product is
# the bit. Fixed, since a filter is tested with the same ones it was built with.
_MULTIPLIERS = (
    0x47B6137B, 0x44974D91, 0x2824AD5B, 0x22B7289D, 0x705495C7, 0x2DF1424B, 0x1EFC4947, 0x5C6BFB31,
)


def _block(columns: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(*columns), 32), F.lit(blocks))


def _low(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit(_LOW))


def _masks(low: Column) -> list[Column]:
    """The bits of a key in each word of its block."""
    bits = [
        F.shiftright((low * F.lit(m)).bitwiseAND(F.lit(_LOW)), 26).cast("int")
        for m in _MULTIPLIERS
    ]

    def one(bit: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)

    return [one(bits[2 * k]).bitwiseOR(one(bits[2 * k + 1] + 32)) for k in range(_WORDS)]


class Sieve:
    """A filter over the key columns of a list; made by ``sieve_of``."""

    def __init__(self, words: DataFrame, blocks: int, keys: int):
        self.words, self.blocks, self.keys = words, blocks, keys

    def matches(self, columns: Sequence[str]) -> Column:
        """Join condition between a row's key columns and the filter."""
        return self._found(_block(columns, self.blocks), _low(columns))

    @staticmethod
    def _found(block: Column, low: Column) -> Column:
        missing = [F.bitwise_not(F.col(f"_sieve_{k}")).bitwiseAND(mask)
                   for k, mask in enumerate(_masks(low))]
        return (block == F.col(_BLOCK)) & (reduce(Column.bitwiseOR, missing) == 0)

    def maybe(self, df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
        """Rows whose key may be listed, of those for which ``where`` holds."""
        return df.join(F.broadcast(self.words), self._test(columns, where), "left_semi")

    def surely_not(self, df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
        """All other rows: their key is certainly not listed, or ``where`` does not hold."""
        return df.join(F.broadcast(self.words), self._test(columns, where), "left_anti")

    def marked(self, df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        """``df`` with a boolean column: whether a row's key may be listed.

        The hash is a column of its own before the join: generated code for wide rows stays small enough
        to be compiled.
        """
        hashed = df.select("*", _block(columns, self.blocks).alias("_at"), _low(columns).alias("_low"))
        test = self._found(F.col("_at"), F.col("_low"))
        found = hashed.join(F.broadcast(self.words), test, "left")
        return found.select(*df.columns, F.col(_BLOCK).isNotNull().alias(name))

    def _test(self, columns: Sequence[str], where: Column | None) -> Column:
        found = self.matches(columns)
        return found if where is None else found & where

    def false_positives(self) -> float:
        """Expected share of unlisted keys that pass by mistake."""
        load = self.keys / self.blocks
        share, blocks_with = 0.0, math.exp(-load)
        for n in range(int(load + 12 * math.sqrt(load) + 20)):  # n keys in a block: Poisson
            share += blocks_with * (1 - (1 - 1 / 32) ** n) ** 8
            blocks_with *= load / (n + 1)
        return share


def blocks_for(keys: int, max_bytes: int = MAX_BYTES) -> int | None:
    """Number of blocks for so many keys; None if the limit leaves too few bits per key."""
    most = max_bytes // _BLOCK_BYTES
    blocks = min(max(1, math.ceil(keys * BITS_PER_KEY / _BLOCK_BITS)), most)
    return blocks if blocks * _BLOCK_BITS >= keys * LEAST_BITS else None


def sieve_of(keys: DataFrame, staging: Staging, max_bytes: int = MAX_BYTES) -> Sieve | None:
    """A stored filter of all columns of ``keys``, or None if the list is too long for one.

    ``keys`` is read twice (it is counted first) and should be a stored table. Repeated keys
    only make the filter larger than it need be.
    """
    columns, n = keys.columns, keys.count()
    blocks = blocks_for(n, max_bytes)
    if blocks is None:
        return None
    masked = keys.select(
        _block(columns, blocks).alias(_BLOCK),
        *[m.alias(f"_sieve_{k}") for k, m in enumerate(_masks(_low(columns)))],
    )
    words = masked.groupBy(_BLOCK).agg(
        *[F.bit_or(f"_sieve_{k}").alias(f"_sieve_{k}") for k in range(_WORDS)]
    )
    return Sieve(staging(words, "sieve"), blocks, n)
