"""Helpers shared by the operators: sessions, stored steps, texts of an Arrow batch, columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from claimlink.session import configure
from claimlink.sources.tables import Staging

ROWS_PER_BATCH = 500
BYTES_PER_BATCH = "16m"


def prepare(spark: SparkSession) -> SparkSession:
    """Run-time settings, with small Arrow batches: a batch of texts must fit a worker's memory.

    Shuffle files go when the step that wrote them is stored, not when the driver happens to
    collect its garbage.
    """
    configure(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)
    return spark


_STEPS: ContextVar[Staging | None] = ContextVar("steps", default=None)


def staging(spark: SparkSession) -> Staging:
    """Stored steps in the shared folder of ``spark.checkpoint.dir``: the caller's, or new ones."""
    return _STEPS.get() or Staging(spark)


@contextmanager
def steps_in(store: Staging) -> Iterator[Staging]:
    """Operators called inside store their steps in ``store``; its ``drop()`` removes them all.

    Results read stored steps when they run, so drop them after that.
    """
    before = _STEPS.set(store)
    try:
        yield store
    finally:
        _STEPS.reset(before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns, like ``names`` but taken by no column of ``df`` in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+``: what ``bytes.split`` parts is exactly this."""
    return text.split()


def batch(schema: pa.Schema, columns: Sequence[Iterable]) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for f, c in zip(schema, columns, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def fields(*pairs: tuple[str, str]) -> T.StructType:
    """A schema of (name, type) with type one of long, int, double, string, boolean, binary."""
    kinds = {
        "long": T.LongType(),
        "int": T.IntegerType(),
        "double": T.DoubleType(),
        "string": T.StringType(),
        "boolean": T.BooleanType(),
        "binary": T.BinaryType(),
        "longs": T.ArrayType(T.LongType()),
        "doubles": T.ArrayType(T.DoubleType()),
    }
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])
