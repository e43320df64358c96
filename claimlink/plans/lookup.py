"""Finding one claim's rows in stored stage tables without reading the tables.

A table is stored in order of the claim id: ranges of ids are dealt to files, each file is sorted, and
its row groups carry the least and greatest id and a Bloom filter. Beside it lies a directory of its
files with the ids each begins and ends with. A lookup asks the directory which files can hold the
claim, mostly one, opens no other, and reads in it the row groups that can hold it.

An id with very many rows (one claim may hold any share) goes over several files: the order goes on
through a hash of the row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlink.sources import Staging, load_table, save

_SPREAD, _FILE = "_spread", "_file"


@dataclass(frozen=True)
class LookupTable:
    """A stored table in order of its ids, and the directory of its files."""

    rows: DataFrame
    files: DataFrame
    column: str

    def files_with(self, wanted: Sequence[str]) -> list[str]:
        """The files whose range of ids holds one of the wanted ones."""
        within = [
            (F.col("least") <= F.lit(w)) & (F.col("greatest") >= F.lit(w)) for w in wanted
        ]
        hit = reduce(lambda x, y: x | y, within, F.lit(False))
        return sorted(r["file"] for r in self.files.filter(hit).collect())

    def find(self, *wanted: str) -> DataFrame:
        """All rows with one of the ids, read from the files that can hold them."""
        spark, files = self.rows.sparkSession, self.files_with(wanted)
        if not files:
            return self.rows.limit(0)
        reader = spark.read.schema(self.rows.schema)
        return reader.parquet(*files).filter(F.col(self.column).isin(*wanted))


def store_for_lookup(
    df: DataFrame, staging: Staging, name: str, column: str = "claim_id", files: int | None = None
) -> LookupTable:
    """``df`` stored in order of ``column``, with its directory.

    Rows without an id are stored, too; no lookup finds them. ``files`` is the number of ranges;
    by default the session's shuffle partitions, merged at run time where they come out small.
    """
    clashes = {_SPREAD, _FILE} & set(df.columns)
    if clashes:
        raise ValueError(f"columns {sorted(clashes)} are taken")
    order = [column, _SPREAD]
    spread = df.withColumn(_SPREAD, F.xxhash64(*df.columns))
    dealt = spread.repartitionByRange(*([files] if files else []), *order)
    path = staging.path(name)
    writer = dealt.sortWithinPartitions(*order).drop(_SPREAD).write.mode("errorifexists")
    writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
        f"parquet.bloom.filter.adaptive.enabled#{column}", "true"
    ).parquet(path)
    rows = load_table(df.sparkSession, path)
    ranges = (
        rows.select(F.col("_metadata.file_path").alias("file"), F.col(column).alias("id"))
        .filter(F.col("id").isNotNull())
        .groupBy("file")
        .agg(F.min("id").alias("least"), F.max("id").alias("greatest"))
    )
    directory = save(ranges.coalesce(1), staging.path(f"{name}_files"), mode="errorifexists")
    return LookupTable(rows, directory, column)


def trace_stored(stages: Mapping[str, LookupTable], claim_id: str) -> DataFrame:
    """Rows of one claim in every stored stage, with the stage's name; no stage is read whole."""
    found = [
        table.find(claim_id).withColumn("stage", F.lit(name)) for name, table in stages.items()
    ]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), found)
