"""Input tables in their declared types, and stored steps."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlink.schema import BRIDGE_SCHEMA, CODES_SCHEMA, NUMBERS, raw_schema
from claimlink.session import staging_root


def conform(df: DataFrame, schema: T.StructType, rename: dict[str, str] | None = None) -> DataFrame:
    """Select the columns of ``schema``, cast to its types; numbers keep their own.

    ``rename`` maps our column name to the name in ``df``. Columns outside the schema are
    not read. Amounts are link keys, so a number never loses digits: decimal and whole types
    pass as they are, text and floating point are refused.
    """
    rename = rename or {}

    def column(f: T.StructField):
        name = rename.get(f.name, f.name)
        if f.name not in NUMBERS:
            return F.col(name).cast(f.dataType)
        kind = df.schema[name].dataType
        if isinstance(kind, T.NullType):
            return F.col(name).cast(f.dataType)
        if not isinstance(kind, (T.DecimalType, T.IntegralType)):
            raise ValueError(f"{name} is {kind.simpleString()}: cast it to a decimal type first")
        return F.col(name)

    return df.select(*[column(f).alias(f.name) for f in schema])


def exact_type(x: T.DataType, y: T.DataType) -> T.DataType:
    """The narrowest decimal that holds every value of two number types; equal types stay."""
    if x == y:
        return x
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}

    def parts(t: T.DataType) -> tuple[int, int]:
        if isinstance(t, T.DecimalType):
            return t.precision - t.scale, t.scale
        return digits[type(t)], 0

    whole = max(parts(x)[0], parts(y)[0])
    scale = max(parts(x)[1], parts(y)[1])
    if whole + scale > T.DecimalType(38).precision:
        raise ValueError(f"no decimal holds both {x.simpleString()} and {y.simpleString()}")
    return T.DecimalType(whole + scale, scale)


def with_common_numbers(x: DataFrame, y: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with one type per number column, wide enough for either."""
    for c in NUMBERS:
        kind = exact_type(x.schema[c].dataType, y.schema[c].dataType)
        x, y = (t.withColumn(c, F.col(c).cast(kind)) for t in (x, y))
    return x, y


def load_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """A table by catalog name, or by path when the name holds a slash."""
    return spark.read.format(fmt).load(name) if "/" in name else spark.table(name)


def load_claims(
    spark: SparkSession, name: str, kind: str, rename: dict[str, str] | None = None
) -> DataFrame:
    """Raw treatment or procedure claims."""
    return conform(load_table(spark, name), raw_schema(kind), rename)


def load_bridge(spark: SparkSession, name: str, rename: dict[str, str] | None = None) -> DataFrame:
    """Original token pair -> bridged token pair."""
    return conform(load_table(spark, name), BRIDGE_SCHEMA, rename)


def load_codes(spark: SparkSession, name: str, rename: dict[str, str] | None = None) -> DataFrame:
    """Code reference with its four group columns."""
    return conform(load_table(spark, name), CODES_SCHEMA, rename)


def save(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> DataFrame:
    """Create or replace a table (a folder, when the name holds a slash) and read it back."""
    writer = df.write.mode(mode).format(fmt)
    if "/" in name:
        writer.save(name)
    else:
        writer.saveAsTable(name)
    return load_table(df.sparkSession, name, fmt)


class Staging:
    """Steps stored once and read several times.

    Each instance writes below a folder of its own in the shared checkpoint folder, so a lost
    executor costs a re-read and not a recomputation, and later steps prune columns and push
    filters into the stored files. A stored step is never overwritten, as earlier results may
    still read it: storing a name again gives it another folder. ``drop`` removes them all.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        base = (root or staging_root(spark)).rstrip("/")
        self.spark = spark
        self.folder = f"{base}/claimlink-{uuid.uuid4().hex}"
        self._stored = itertools.count()

    def path(self, name: str) -> str:
        """A folder of its own for a step that is written by the caller."""
        return f"{self.folder}/{next(self._stored):03d}-{name}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return save(df, self.path(name), mode="errorifexists")

    def partitioned(
        self, df: DataFrame, name: str, by: Sequence[str], ids: Sequence[str] = ()
    ) -> DataFrame:
        """A step stored in a folder per value of the columns ``by``, which come last in it.

        The schema is kept, not guessed from the folders' names. An empty text would come back as
        NULL from a name, so ``by`` must not hold any. ``ids`` names columns with very many values:
        they are written plainly, without a dictionary that would be filled and thrown away in
        every folder of every task.
        """
        path = self.path(name)
        writer = df.write.mode("errorifexists").partitionBy(*by)
        for c in ids:
            writer = writer.option(f"parquet.enable.dictionary#{c}", "false")
        writer.parquet(path)
        kept = [c for c in df.columns if c not in by]
        schema = T.StructType([df.schema[c] for c in (*kept, *by)])
        return self.spark.read.schema(schema).parquet(path).select(*kept, *by)

    def drop(self) -> None:
        """Delete the steps of this instance; nothing that reads them can run afterwards."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
