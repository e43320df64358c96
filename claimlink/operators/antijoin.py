"""NOT IN over ledgers of any size.

Spark runs SQL ``NOT IN`` as a broadcast join whatever the size of the list. The same result
comes from an ordinary (shuffled, skew-splittable) anti join plus what SQL says about NULLs:

* empty ledger: every row passes, NULL keys included;
* ledger with a NULL: no row passes;
* otherwise: rows with a key that is not in the ledger.

Which case holds is a scalar subquery over the ledger, so NULL keys never reach the shuffle
unless they have to come out again.

With a sieve (a Bloom filter of the ledger, see ``operators/sieve.py``) only rows that may be listed
are shuffled. All others leave by a broadcast join with the filter, wherever they lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.operators.sieve import Sieve, sieve_of
from claimlink.sources import Staging

_EMPTY, _PLAIN, _HAS_NULL = 0, 1, 2
_LEDGER_KEY = "_ledger_key"
_LEDGER_RUN = "_ledger_run"


def _states(ledger: DataFrame, values: Sequence[int] | None) -> list[Column]:
    """One scalar per ledger: empty, plain or with a NULL key."""

    def state(rows: Column) -> Column:
        return (
            F.when(F.count_if(rows) == 0, F.lit(_EMPTY))
            .when(F.count_if(rows & F.col(_LEDGER_KEY).isNull()) > 0, F.lit(_HAS_NULL))
            .otherwise(F.lit(_PLAIN))
        )

    conditions = [F.lit(True)] if values is None else [F.col(_LEDGER_RUN) == v for v in values]
    states = ledger.agg(F.array(*[state(c) for c in conditions]).alias("states")).scalar()
    return [states.getItem(i) for i in range(len(conditions))]


def _distinct(keys: DataFrame) -> DataFrame:
    """Each (run, key) once, NULL keys left out.

    Grouping by a digest as well changes the partitioning, not the result: the list then reaches
    the join by a shuffle of its own, which adaptive execution needs to split hot keys of the
    other side.
    """
    return (
        keys.filter(F.col(_LEDGER_KEY).isNotNull())
        .withColumn("digest", F.xxhash64(_LEDGER_KEY))
        .distinct()
        .drop("digest")
    )


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions)


def not_in(
    df: DataFrame,
    key: str,
    ledger: DataFrame,
    by: str | None = None,
    values: Sequence[int] | None = None,
    tested: str | None = None,
    sieve: Sieve | None = None,
    unlisted: bool = False,
) -> DataFrame:
    """Rows of ``df`` whose ``key`` is NOT IN the one key column of ``ledger``.

    With ``by``, ``ledger`` has the columns (by, key) and holds one list per value; a row is
    tested against the list of its own value only. ``values`` names the values that occur.
    ``tested`` names a boolean column: rows where it is false stay without a test. The ledger
    may hold a key several times.

    ``sieve`` (see ``ledger_sieve``) holds the ledger's columns; ``df`` is then read twice and
    should be a stored table. ``unlisted`` says that no key of ``df`` is in the ledger: what SQL says
    about empty and NULL-holding lists is then all that is left to test.
    """
    if by is None:
        keys = ledger.toDF(_LEDGER_KEY)
        (state,) = _states(keys, None)
        passes = (state == _EMPTY) | ((state == _PLAIN) & F.col(key).isNotNull())
        match = F.col(key) == F.col(_LEDGER_KEY)
    else:
        keys = ledger.toDF(_LEDGER_RUN, _LEDGER_KEY)
        states = _states(keys, values)
        passes = _any(
            [
                (F.col(by) == v)
                & ((s == _EMPTY) | ((s == _PLAIN) & F.col(key).isNotNull()))
                for v, s in zip(values, states, strict=True)
            ]
        )
        match = (F.col(key) == F.col(_LEDGER_KEY)) & (F.col(by) == F.col(_LEDGER_RUN))
    if tested is not None:
        passes = passes | ~F.col(tested)
        match = match & F.col(tested)
    if unlisted:
        return df.filter(passes)
    rows, listed = df.filter(passes), _distinct(keys)
    if sieve is None:
        return rows.join(listed, match, "left_anti")
    columns = [key] if by is None else [by, key]
    doubtful = sieve.maybe(rows, columns, None if tested is None else F.col(tested))
    rest = sieve.surely_not(rows, columns, None if tested is None else F.col(tested))
    return rest.union(doubtful.join(listed, match, "left_anti"))


def ledger_sieve(ledger: DataFrame, staging: Staging, max_bytes: int | None = None) -> Sieve | None:
    """The sieve of a stored ledger's keys that are not NULL; None for a ledger too long for one.

    A ledger with a run column keeps its column names: they must be those of the rows tested.
    """
    keys = ledger.filter(F.col(ledger.columns[-1]).isNotNull())
    return sieve_of(keys, staging) if max_bytes is None else sieve_of(keys, staging, max_bytes)


def not_in_every(
    df: DataFrame,
    key: str,
    ledger: DataFrame,
    by: str,
    values: Sequence[int],
    unlisted: bool = False,
) -> DataFrame:
    """Rows that pass NOT IN for at least one of the lists in ``ledger`` (by, key).

    This is the union of one NOT IN per list, in a single pass: a row is out only when it is
    out of every list, that is when every list that could let it through holds its key.
    ``unlisted`` is that of ``not_in``.
    """
    keys = ledger.toDF(_LEDGER_RUN, _LEDGER_KEY)
    states = _states(keys, values)
    any_empty = _any([s == _EMPTY for s in states])
    any_plain = _any([s == _PLAIN for s in states])
    passes = any_empty | (any_plain & F.col(key).isNotNull())
    if unlisted:
        return df.filter(passes)
    plain_lists = reduce(
        lambda x, y: x + y, [F.when(s == _PLAIN, F.lit(1)).otherwise(F.lit(0)) for s in states]
    )
    in_plain = _any(
        [(F.col(_LEDGER_RUN) == v) & (s == _PLAIN) for v, s in zip(values, states, strict=True)]
    )
    blocked = (
        _distinct(keys.filter(in_plain))
        .groupBy(_LEDGER_KEY, F.xxhash64(_LEDGER_KEY).alias("digest"))
        .agg(F.count(F.lit(1)).alias("lists"))
        .filter((F.col("lists") == plain_lists) & ~any_empty)
        .select(_LEDGER_KEY)
    )
    return df.filter(passes).join(blocked, F.col(key) == F.col(_LEDGER_KEY), "left_anti")
