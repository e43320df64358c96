"""Whitening of embeddings over their distinct vectors.

Components become whole numbers, so that equal vectors are equal exactly. Equal vectors are grouped, and
the covariance is fitted on the groups: a group's weight is one, or its number of copies. Means come
from exact sums; then blocks of vectors are centred and multiplied (one weighted product of matrices
per Arrow batch, summed per task, then per entry), so no pass holds more than a block and a matrix of
the dimension. The eigenvectors of that matrix whiten each distinct vector once, and the rows get
their vector's result by a join. The few vectors that a thousandth of all rows or more share, at most
a thousand, are joined by broadcast; for the others no key holds more than that share.

Defined results: rows with a null vector, or one with a null or non-finite component, are dropped. A
null id stays, repeated rows stay each. Vectors of another length than most distinct ones (ties: the
longest) share no covariance with them and have no components, as have empty vectors: no rows.
Components whose eigenvalue is nothing beside the trace (fewer distinct vectors than dimensions) are
left out, so a single distinct vector gives no rows. A deviation beyond 64 bits raises. Extra columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlink.llm.common import arrow_schema, batch, fields, staging
from claimlink.llm.vectors import matrix, most_common_length, quantised, usable

COMPONENTS = 4
HOT_SHARE = 1000
NOTHING = 1e-12  # of the trace

WHITENED = fields(("x", "longs"), ("deviation", "long"), ("whitened", "doubles"), ("weight", "long"))
RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double,"
    " identity_error double"
)


@dataclass
class Model:
    """What a fit found; ``axes`` has a unit eigenvector per column."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(x, copies): every vector once."""
    return vectors.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))


def _weights(b: pa.RecordBatch) -> np.ndarray:
    return b.column("weight").to_numpy()


def exact_sums(weighted: DataFrame) -> tuple[int, list[int]]:
    """Sum of the weights, and weighted sum per dimension, of (x, weight)."""

    def run(batches):
        total, weight = None, 0
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("x")).astype(object)  # whole numbers of any size
                part = (x * _weights(b).astype(object)[:, None]).sum(axis=0)
                total = part if total is None else total + part
                weight += int(_weights(b).sum())
        if total is not None:
            rows = [weight, *total.tolist()]
            sums = pa.array([str(v) for v in rows], pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(rows) - 1), pa.int32()), sums], names=["at", "sum"]
            )

    parts = weighted.mapInArrow(run, "at int, sum string")
    total = F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    found = sorted((r["at"], int(r["sum"])) for r in parts.groupBy("at").agg(total).collect())
    return found[0][1], [s for _, s in found[1:]]


def covariance(weighted: DataFrame, name: str, n: float, mean: np.ndarray) -> np.ndarray:
    """Weighted covariance (divisor ``n``) of the vectors ``name``, centred before multiplying."""

    def run(batches):
        total = np.zeros((len(mean), len(mean)))
        for b in batches:
            if b.num_rows:
                centred = matrix(b.column(name)) - mean
                total += (centred * _weights(b)[:, None]).T @ centred
        at = np.triu_indices(len(mean))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)),
             pa.array(total[at])],
            names=["i", "j", "value"],
        )

    entries = weighted.select(name, "weight").mapInArrow(run, "i int, j int, value double")
    found = np.zeros((len(mean), len(mean)))
    for r in entries.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        found[r["i"], r["j"]] = found[r["j"], r["i"]] = r["value"] / n
    return found


def fit(weighted: DataFrame, components: int = COMPONENTS) -> Model:
    """Axes of the largest variance of (x, weight) with vectors of one length."""
    n, sums = exact_sums(weighted)
    mean = np.array([s / n for s in sums])
    values, axes = np.linalg.eigh(covariance(weighted, "x", n, mean))
    trace = float(values.sum())
    order = [k for k in np.argsort(-values, kind="stable")[:components]
             if values[k] > NOTHING * trace]
    axes = axes[:, order]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), range(len(order))])
    return Model(n, sums, values[order], axes * signs, trace)


def squared_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n * x - S)^2, exact whatever its size."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if largest * largest * len(sums) < 2**63:
        return ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
    return ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1).tolist()


def whiten_distinct(weighted: DataFrame, model: Model) -> DataFrame:
    """(x, deviation, whitened, weight) of every distinct vector."""
    schema, scale = arrow_schema(WHITENED), np.sqrt(model.values)

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("x"))
                white = (x - model.mean) @ model.axes / scale
                deviation = squared_deviations(x, model.n, model.sums)
                yield batch(schema, [b.column("x"), deviation, list(white), _weights(b)])

    return weighted.select("x", "weight").mapInArrow(run, WHITENED)


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    sums = whitened.select(
        *[F.sum(F.col("whitened")[k] * F.col("weight")) for k in range(components)]
    ).first()
    mean = np.array([s / n for s in sums])
    return float(np.abs(covariance(whitened, "whitened", n, mean) - np.eye(components)).max())


def join_back(rows: DataFrame, results: DataFrame, copies: DataFrame, total: int) -> DataFrame:
    """Every row with its vector's result. ``copies`` has (x, copies) of the vectors."""
    hot = copies.filter(F.col("copies") * HOT_SHARE >= F.lit(total)).select("x")
    hot_results = results.join(F.broadcast(hot), "x", "left_semi")  # at most HOT_SHARE vectors
    columns = ["vec_id", *[c for c in results.columns if c != "x"]]
    few = rows.join(F.broadcast(hot_results), "x").select(*columns)
    rest = rows.join(F.broadcast(hot), "x", "left_anti").join(results, "x").select(*columns)
    return few.union(rest)


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, weights: str = "one"
) -> DataFrame:
    """One row per usable row of ``embeddings`` (vec_id, embedding) and component.

    ``weights``: "one" fits every distinct vector once, "copies" as often as it occurs.
    """
    if weights not in ("one", "copies"):
        raise ValueError(f"weights {weights!r}: one or copies")
    spark, store = embeddings.sparkSession, staging(embeddings.sparkSession)
    vector = embeddings["embedding"]
    rows = embeddings.filter(usable(vector)).select(
        embeddings["vec_id"].cast("long").alias("vec_id"), quantised(vector).alias("x")
    )
    vectors = store(distinct_vectors(rows), "vectors")
    length = most_common_length(vectors)
    vectors = vectors.filter(F.size("x") == length)
    if not length:
        return spark.createDataFrame([], RESULT)
    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    weighted = vectors.withColumn("weight", weight)
    model = fit(weighted, components)
    found = len(model.values)
    if not found:
        return spark.createDataFrame([], RESULT)
    whitened = store(whiten_distinct(weighted, model), "whitened")
    error = identity_error(whitened, model.n, found)
    total = vectors.agg(F.sum("copies")).first()[0]
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return (
        join_back(rows, whitened.drop("weight"), vectors, total)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            explained[F.col("at")].alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
