"""Hard negatives by angular triangle filtering, with exact integer scores.

Every row stores its norm and its angles to a few reference directions. For an anchor at angle s to a
direction and a row at angle t, the angle between the two lies in [|s - t|, min(s + t, 2 pi - s - t)], so
the cosine lies in an interval; times both norms, and widened by more than rounding can lose, it bounds
the score. Rows are stored in order of the nearest direction and the angle to it, so slabs of
neighbouring rows share narrow intervals, and a slab is scored for those anchors only whose wanted
scores overlap its bounds. What is wanted is a window of scores per anchor: from its last positive so
far up for positives, and per positive a part of its score for negatives. Scores are inner products of
whole numbers, exact.

Anchors are taken in blocks of bounded bytes, each of which meets all rows: a task keeps the best of
every window, and the best of all tasks are ranked after a shuffle by anchor. A block first meets the
anchors themselves: what it finds among them is a floor for the search among all rows, so tasks send
only rows that can be among the best, however many tasks there are. Nothing but one block and its
positives passes through the driver.

Defined results: rows with a null id, a null label, a null vector, or a null or non-finite component
take no part. Repeated rows count once; rows of one id with other labels or vectors are rows of their
own, in order of id, then label, then place. Of vectors of different lengths the shorter one goes on
with zeros. An anchor without positives, or without rows in a window, gives no rows for it. Scores that
may not fit 64 bits raise. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlink.llm.common import arrow_schema, batch, fields, staging
from claimlink.llm.vectors import as_lists, matrix, quantised, usable
from claimlink.sources.tables import Staging, save

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive's score
REFERENCES = 16
REFERENCE_SAMPLE = 2_000  # rows the directions are chosen from; they change time, not results
BLOCK_BYTES = 8 << 20  # of the anchors that are searched for at once
TASK_ROWS = 8_192
SLAB_ROWS = 256
PENDING = 200_000  # candidates a task holds before it drops all but the best
SLACK = 1e-6  # radians; arc cosines are off by 2e-8 at most
EXACT = 2**53  # whole numbers below are exact as doubles

STORED = fields(
    ("vec_id", "long"),
    ("label", "int"),
    ("x", "longs"),
    ("norm", "double"),
    ("near", "int"),
    ("angle", "double"),
    ("angles", "doubles"),
)
FOUND = fields(
    ("anchor", "long"),
    ("anchor_id", "long"),
    ("window", "int"),
    ("score", "long"),
    ("row", "long"),
    ("vec_id", "long"),
    ("label", "int"),
)
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long,"
    " negative_score long"
)


@dataclass
class Vectors:
    """Rows as arrays: the anchors of a block, or a slab of the rows they meet."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    @staticmethod
    def of(table: pa.Table | pa.RecordBatch) -> Vectors:
        plain = [table.column(c).to_numpy() for c in ("row", "vec_id", "label")]
        norm = table.column("norm").to_numpy()
        return Vectors(*plain, matrix(table.column("x")), norm, matrix(table.column("angles")))

    def __len__(self) -> int:
        return len(self.row)

    def take(self, at) -> Vectors:
        return Vectors(*[getattr(self, c)[at] for c in self.__dataclass_fields__])


@dataclass
class Block:
    """Anchors with the scores each wants: windows [low, high], one per column."""

    anchors: Vectors
    low: np.ndarray
    high: np.ndarray
    same: bool  # rows of the anchor's label, or of the others
    keep: int


def directions(sample: np.ndarray, number: int = REFERENCES) -> np.ndarray:
    """Unit vectors far apart: the sample's mean first, then whatever is farthest from all so far."""
    norms = np.linalg.norm(sample, axis=1)
    units = sample[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(max(1, sample.shape[1]))[:1, : sample.shape[1]]
    mean = units.mean(axis=0)
    size = np.linalg.norm(mean)
    found = [mean / size if size > 1e-9 else units[0]]
    nearest = units @ found[0]
    while len(found) < number and nearest.min() < 1 - 1e-9:
        found.append(units[nearest.argmin()])
        nearest = np.maximum(nearest, units @ found[-1])
    return np.array(found)


def score_bounds(anchors: Vectors, slab: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each anchor can have with any row of the slab."""
    least, most = slab.angles.min(axis=0), slab.angles.max(axis=0)
    s = anchors.angles
    apart = np.maximum(0, np.maximum(s - most, least - s)).max(axis=1) - SLACK
    within = np.minimum(s + most, 2 * np.pi - s - least).min(axis=1) + SLACK
    high, low = np.cos(np.clip(apart, 0, np.pi)), np.cos(np.clip(within, 0, np.pi))
    small, large = slab.norm.min(), slab.norm.max()
    margin = 1e-9 * anchors.norm * large
    upper = anchors.norm * high * np.where(high >= 0, large, small) + margin
    lower = anchors.norm * low * np.where(low >= 0, small, large) - margin
    return lower, upper


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, exact."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if largest < 2**63:
        return a @ b.T
    raise ValueError("components too large for scores of 64 bits")


class Search:
    """The best rows of every window of a block, among the rows of one task."""

    def __init__(self, block: Block):
        self.block, self.low = block, block.low.copy()
        self.windows = block.low.shape[1]
        self.scored = 0
        self.slots = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.rows: list[np.ndarray] = [np.empty(0, np.int64)] * 3  # row, vec_id, label
        self.pending: list[tuple] = []

    def add(self, slab: Vectors) -> None:
        block, low = self.block, self.low
        lower, upper = score_bounds(block.anchors, slab)
        overlaps = (upper[:, None] >= low) & (lower[:, None] <= block.high) & (low <= block.high)
        chosen = np.flatnonzero(overlaps.any(axis=1))
        if not len(chosen):
            return
        self.scored += len(chosen) * len(slab)
        anchors = block.anchors
        got = scores(anchors.x[chosen], slab.x)
        fits = (anchors.label[chosen, None] == slab.label) == block.same
        fits &= got >= low[chosen].min(axis=1)[:, None]
        fits &= got <= block.high[chosen].max(axis=1)[:, None]
        at, row = np.nonzero(fits)
        other = anchors.row[chosen[at]] != slab.row[row]
        at, row = at[other], row[other]
        anchor, found = chosen[at], got[at, row]
        for w in range(self.windows):
            inside = (found >= low[anchor, w]) & (found <= block.high[anchor, w])
            r = row[inside]
            self.pending.append(
                (anchor[inside] * self.windows + w, found[inside],
                 slab.row[r], slab.vec_id[r], slab.label[r])
            )
        if sum(len(p[0]) for p in self.pending) > max(PENDING, 2 * block.keep * low.size):
            self.settle()

    def settle(self) -> None:
        """Keep the best of each window, and ask for nothing below its last."""
        held = (self.slots, self.score, *self.rows)
        slots, score, *rows = [np.concatenate(c) for c in zip(held, *self.pending, strict=True)]
        self.pending = []
        order = np.lexsort((rows[0], rows[2], rows[1], -score, slots))
        slots = slots[order]
        first = np.searchsorted(slots, slots)
        place = np.arange(len(slots)) - first
        last = order[place == self.block.keep - 1]
        self.low.reshape(-1)[slots[place == self.block.keep - 1]] = score[last]
        kept = order[place < self.block.keep]
        self.slots, self.score = slots[place < self.block.keep], score[kept]
        self.rows = [c[kept] for c in rows]

    def found(self) -> list:
        """Columns of ``FOUND``."""
        self.settle()
        anchor = self.slots // self.windows
        own = self.block.anchors
        return [own.row[anchor], own.vec_id[anchor], self.slots % self.windows, self.score,
                *self.rows]


@contextmanager
def sent(spark: SparkSession, block: Block) -> Iterator[Broadcast]:
    """A block on all executors, until what is found with it is stored or collected."""
    shared = spark.sparkContext.broadcast(block)
    try:
        yield shared
    finally:
        shared.destroy()


def search(candidates: DataFrame, shared: Broadcast) -> DataFrame:
    """``FOUND`` with ``place``: the best ``keep`` candidates of every window, from place 1."""
    schema, keep = arrow_schema(FOUND), shared.value.keep

    def run(batches: Iterator[pa.RecordBatch]):
        task = Search(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, SLAB_ROWS):
                task.add(Vectors.of(b.slice(at, SLAB_ROWS)))
        columns = task.found()
        for at in range(0, len(columns[0]), 100_000):
            yield batch(schema, [c[at : at + 100_000] for c in columns])

    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "label", "row")
    found = candidates.select("row", "vec_id", "label", "x", "norm", "angles")
    return (
        found.mapInArrow(run, FOUND)
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= keep)
    )


def collected(candidates: DataFrame, block: Block) -> tuple[np.ma.MaskedArray, np.ndarray]:
    """Scores and ids per anchor, window and place of a block's search (at most ``keep`` each)."""
    shape = (*block.low.shape, block.keep)
    score, ids = np.zeros(shape, np.int64), np.full(shape, -1, np.int64)
    there = np.zeros(shape, bool)
    with sent(candidates.sparkSession, block) as shared:
        found = search(candidates, shared)
        table = found.select("anchor", "window", "place", "score", "vec_id").toArrow()
    columns = [table.column(c).to_numpy() for c in table.column_names]
    order = np.argsort(block.anchors.row)
    at = order[np.searchsorted(block.anchors.row, columns[0], sorter=order)]
    where = at, columns[1], columns[2] - 1
    score[where], ids[where], there[where] = columns[3], columns[4], True
    return np.ma.masked_array(score, ~there), ids


def floors(block: Block, score: np.ma.MaskedArray) -> Block:
    """The same search, for nothing below the last of the best that were found already."""
    last = score[:, :, -1]
    return replace(block, low=np.maximum(block.low, last.filled(np.iinfo(np.int64).min)))


def negative_windows(score: np.ma.MaskedArray, low: int, high: int) -> tuple:
    """[ceil(low % of a positive's score), floor(high % of it)]; nothing where there is none."""
    filled = score.filled(0)
    if len(filled) and int(np.abs(filled).max(initial=0)) >= 2**63 // 100:
        raise ValueError("components too large for scores of 64 bits")
    none = score.mask if score.mask.shape else np.zeros(filled.shape, bool)
    bottom, top = -(-low * filled // 100), high * filled // 100
    return np.where(none, 1, bottom), np.where(none, 0, top)


def placed(vectors: DataFrame, store: Staging) -> DataFrame:
    """(vec_id, label, x) as stored rows with number, norm and angles, neighbours side by side."""
    rows = store(vectors.distinct(), "vectors")
    length, n = rows.agg(F.max(F.size("x")), F.count(F.lit(1))).first()
    length = max(1, length or 0)

    def padded(column) -> np.ndarray:
        if pc.all(pc.equal(pc.list_value_length(column), length)).as_py():
            return matrix(column)
        lists = column.to_pylist()
        out = np.zeros((len(lists), length), np.int64)
        for k, values in enumerate(lists):
            out[k, : len(values)] = values
        return out

    sample = rows.orderBy(F.xxhash64("vec_id", "x")).limit(REFERENCE_SAMPLE).select("x").toArrow()
    reference = directions(padded(sample.column("x")).astype(float))
    schema = arrow_schema(STORED)

    def run(batches):
        for b in batches:
            x = padded(b.column("x"))
            plain = x.astype(float)
            norm = np.linalg.norm(plain, axis=1)
            cosine = plain @ reference.T / np.where(norm > 0, norm, 1)[:, None]
            angles = np.arccos(np.clip(cosine, -1, 1))
            near = angles.argmin(axis=1)
            angle = angles[np.arange(len(x)), near]
            columns = [b.column("vec_id"), b.column("label"), as_lists(x), norm,
                       near.astype(np.int32), angle, as_lists(angles)]
            yield batch(schema, columns)

    order = ["near", "angle", "vec_id", "label"]
    tasks = max(1, math.ceil(n / TASK_ROWS))
    return store(
        rows.mapInArrow(run, STORED)
        .repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .withColumn("row", F.monotonically_increasing_id()),
        "placed",
    )


def mine(
    vectors: DataFrame,
    anchors: Callable[[Column], Column],
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """The first ``negatives`` rows of another label per anchor and positive whose score is within
    ``low`` to ``high`` percent of the positive's.

    ``vectors`` has (vec_id long, label int, x array of long) and no nulls; ``anchors`` is the
    condition on ``vec_id`` that makes a row an anchor.
    """
    spark, store = vectors.sparkSession, staging(vectors.sparkSession)
    rows = placed(vectors.select("vec_id", "label", "x"), store)
    chosen = rows.filter(anchors(F.col("vec_id")))
    number, length = chosen.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not number:
        return spark.createDataFrame([], RESULT)
    blocks = math.ceil(number * length * 8 / BLOCK_BYTES)
    part = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    chosen = store(chosen.withColumn("block", part), "anchors")
    folder = store.path("negatives")
    for k in range(blocks):
        anchors_of = chosen.filter(F.col("block") == k).drop("block").toArrow()
        if anchors_of.num_rows:
            block, named = negatives_wanted(
                Vectors.of(anchors_of), chosen, rows, positives, negatives, low, high
            )
            with sent(spark, block) as shared:
                found = search(rows, shared).join(F.broadcast(named), ["anchor", "window"])
                save(result_columns(found), f"{folder}/block={k}", mode="errorifexists")
    return spark.read.schema(RESULT).parquet(folder).drop("block")


def negatives_wanted(
    anchors: Vectors,
    chosen: DataFrame,
    rows: DataFrame,
    positives: int,
    negatives: int,
    low: int,
    high: int,
) -> tuple[Block, DataFrame]:
    """The windows of a block's anchors, one per positive, and the positives they stand for."""
    limit = np.iinfo(np.int64)
    everything = np.full((len(anchors), 1), limit.min), np.full((len(anchors), 1), limit.max)
    block = Block(anchors, *everything, same=True, keep=positives)
    block = floors(block, collected(chosen, block)[0])
    score, ids = collected(rows, block)
    score, ids = score[:, 0, :], ids[:, 0, :]  # one window; the places are the positives
    block = Block(anchors, *negative_windows(score, low, high), same=False, keep=negatives)
    block = floors(block, collected(chosen, block)[0])
    at = np.argwhere(~np.ma.getmaskarray(score))
    positive = [anchors.row[at[:, 0]], at[:, 1].astype(np.int32), ids[at[:, 0], at[:, 1]],
                score.data[at[:, 0], at[:, 1]]]
    named = pa.table(positive, names=["anchor", "window", "positive_id", "positive_score"])
    return block, rows.sparkSession.createDataFrame(named)


def result_columns(found: DataFrame) -> DataFrame:
    return found.select(
        "anchor_id",
        "positive_id",
        F.col("place").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def labelled_vectors(embeddings: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, x) of the rows of (vec_id, embedding, label) that take part."""
    vector, vec_id = embeddings["embedding"], embeddings["vec_id"]
    there = vec_id.isNotNull() & embeddings["label"].isNotNull() & usable(vector)
    return embeddings.filter(there).select(
        vec_id.cast("long").alias("vec_id"), label.cast("int").alias("label"),
        quantised(vector).alias("x"),
    )
