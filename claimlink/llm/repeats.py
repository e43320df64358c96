"""Places where long runs repeat across a corpus: winnowed anchors and what stands around them.

A run is ``least`` consecutive units (bytes, or words). Grams of ``gram`` units are hashed, and of
every run the gram with the smallest hash is an anchor: equal runs have equal anchors at equal
places. So runs that repeat are found among anchors that repeat, and each anchor answers for the
runs that contain it; together they lie in its context, ``least - gram`` units to both sides of
the gram.

1. Anchors are counted (combined in the map tasks). Those seen twice set a bit in a bitmap of fixed
   size, ``BITS``: the only thing that is broadcast, and no more than a sieve. An anchor let
   through by chance stands alone later.
2. A second pass over the texts emits the anchors that pass the sieve, with a digest of the context.
   Equal contexts of an anchor form a class. A class is one row from here on, however large it is.
3. Anchors with one class are settled by its size. For the others, the context of each class's first
   member is fetched from its document and compared with those of the same anchor by the operator.
4. An anchor with very many different contexts is not put into one task. Its contexts are cut into
   parts that answer for fewer runs each, which then share a longer gram; parts are classed and
   compared in the same way, down to parts that are a single run.

Rows are told apart by document id and text hash, so that repeated ids do no harm.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.llm.common import arrow_schema, batch, fields, texts
from claimlink.sources.tables import Staging

BITS = 27  # the bitmap has 2 ** BITS bits: 16 MB


def sliding(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (a minimum or maximum) over every window of ``size``."""
    step = 1
    while 2 * step <= size:
        x = pick(x[:-step], x[step:])
        step *= 2
    return pick(x[: len(x) - (size - step)], x[size - step :]) if step < size else x


def smallest_of_windows(h: np.ndarray, size: int) -> np.ndarray:
    """Positions whose value is the smallest of some window of ``size`` values; ties all count."""
    if len(h) < size:
        return np.empty(0, np.int64)
    low = np.zeros(len(h) + size - 1, h.dtype)
    low[size - 1 : len(h)] = sliding(h, size, np.minimum)
    return np.flatnonzero(sliding(low, size, np.maximum) == h)


@dataclass(frozen=True)
class Runs:
    """What a run is: ``units`` turns a text into a byte string of ``width`` bytes a unit, and
    ``anchors`` gives positions and hashes of the anchors in it. An anchor with more than ``most``
    different contexts is hot."""

    least: int
    gram: int
    width: int
    units: Callable[[bytes], bytes]
    anchors: Callable[[bytes], tuple[np.ndarray, np.ndarray]]
    most: int  # contexts of one anchor beyond which they are taken apart

    def context(self, position: int, units: int) -> tuple[int, int]:
        side = self.least - self.gram
        return max(0, position - side), min(units, position + self.least)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _key(text: bytes) -> int:
    return int(np.array([xxhash.xxh64_intdigest(text, 42)], np.uint64).view(np.int64)[0])


COUNTED = fields(("anchor", "long"), ("n", "long"))


def repeated_bitmap(docs: DataFrame, runs: Runs) -> np.ndarray:
    """Bits of the anchors seen more than once in the corpus."""
    schema = arrow_schema(COUNTED)

    def emit(batches):
        for b in batches:
            found = [runs.anchors(runs.units(t))[1] for t in texts(b.column("text"))]
            anchors, n = np.unique(np.concatenate([np.empty(0, np.uint64), *found]),
                                   return_counts=True)
            yield batch(schema, [anchors.view(np.int64), n])

    repeated = (
        docs.select("text").mapInArrow(emit, COUNTED)
        .groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")
    )
    bit = F.shiftrightunsigned("anchor", 64 - BITS)
    words = (
        repeated.groupBy(F.shiftright(bit, 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                      bit.bitwiseAND(63).cast("int"))).alias("bits"))
    ).toArrow()  # at most 2 ** (BITS - 6) rows
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bitmap.view(np.uint64)


def _passes(anchors: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bit = anchors >> np.uint64(64 - BITS)
    word = bitmap[(bit >> np.uint64(6)).astype(np.int64)]
    return (word >> (bit & np.uint64(63))) & np.uint64(1) > 0


OCCURRENCES = fields(
    ("anchor", "long"), ("digest", "long"), ("doc_id", "long"), ("pos", "long"), ("key", "long"),
    ("units", "long"),
)


def occurrences(docs: DataFrame, runs: Runs) -> DataFrame:
    """Anchors that may repeat, with the digest of their context and their place."""
    sieve = docs.sparkSession.sparkContext.broadcast(repeated_bitmap(docs, runs))
    schema = arrow_schema(OCCURRENCES)
    digest = xxhash.xxh3_64_intdigest

    def emit(batches):
        bitmap = sieve.value
        for b in batches:
            columns = [[] for _ in schema]
            ids = b.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, texts(b.column("text")), strict=True):
                unit = runs.units(text)
                n = len(unit) // runs.width
                positions, anchors = runs.anchors(unit)
                if not len(positions):
                    continue
                sure = _passes(anchors, bitmap)
                if not sure.any():
                    continue
                key = _key(text)
                positions = positions[sure].tolist()
                columns[0] += anchors[sure].view(np.int64).tolist()
                own = []
                for p in positions:
                    start, end = runs.context(p, n)
                    own.append(digest(unit[start * runs.width : end * runs.width], p - start))
                columns[1] += np.array(own, np.uint64).view(np.int64).tolist()
                columns[2] += [doc_id] * len(positions)
                columns[3] += positions
                columns[4] += [key] * len(positions)
                columns[5] += [n] * len(positions)
            yield batch(schema, columns)

    return docs.select("doc_id", "text").mapInArrow(emit, OCCURRENCES)


def classes(found: DataFrame) -> DataFrame:
    """One row per anchor and context: its size, its first place, and how many contexts and places
    the anchor has."""
    first = F.min(F.struct("doc_id", "pos", "key", "units")).alias("first")
    each = found.groupBy("anchor", "digest").agg(F.count("*").alias("n"), first)
    counts = _per_anchor(each, F.count("*").alias("contexts"), F.sum("n").alias("places"))
    return each.join(counts.filter("places > 1"), "anchor")


def _per_anchor(each: DataFrame, *measures: Column) -> DataFrame:
    """Measures of every anchor.

    Grouping by a digest as well changes the partitioning, not the result: the counts then reach a
    join by a shuffle of their own, which adaptive execution needs to split hot anchors.
    """
    return each.groupBy("anchor", F.xxhash64("anchor").alias("_h")).agg(*measures).drop("_h")


CONTEXTS = fields(
    ("hot", "boolean"), ("anchor", "long"), ("doc_id", "long"), ("key", "long"), ("pos", "long"),
    ("start", "long"), ("context", "binary"),
)


def shipped(docs: DataFrame, several: DataFrame, runs: Runs) -> DataFrame:
    """The contexts of all classes that share their anchor with another class."""
    wanted = several.groupBy(
        F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key")
    ).agg(
        F.collect_list(
            F.struct("anchor", F.col("first.pos").alias("pos"),
                     (F.col("contexts") > runs.most).alias("hot"))
        ).alias("wanted")
    )
    rows = docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    place = ["doc_id", "key"]
    if not rows.groupBy(*place).count().filter("count > 1").isEmpty():
        rows = rows.dropDuplicates(place)  # repeated rows would ship the same places again
    joined = rows.join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    )
    schema, w = arrow_schema(CONTEXTS), runs.width

    def emit(batches):
        for b in batches:
            for doc_id, text, key, rows in zip(
                b.column("doc_id").to_pylist(), texts(b.column("text")),
                b.column("key").to_pylist(), b.column("wanted").to_pylist(), strict=True,
            ):
                unit, out = runs.units(text), []
                for r in rows:
                    start, end = runs.context(r["pos"], len(unit) // w)
                    out.append((r["hot"], r["anchor"], doc_id, key, r["pos"], start,
                                unit[start * w : end * w]))
                for at in range(0, len(out), 2000):
                    yield batch(schema, list(zip(*out[at : at + 2000], strict=True)))

    return joined.select("doc_id", "text", "key", "wanted").mapInArrow(emit, CONTEXTS)


PARTS = fields(
    ("anchor", "long"), ("digest", "long"), ("doc_id", "long"), ("pos", "long"), ("key", "long"),
    ("start", "long"), ("end", "long"), ("context", "binary"),
)


def _parts(hot: DataFrame, runs: Runs, finer: Runs) -> DataFrame:
    """Contexts cut so that a part answers for ``finer.least - finer.gram + 1`` runs.

    Runs are told apart by the distance from their start to the anchor, so equal runs are in parts
    with equal grams.
    """
    schema, w = arrow_schema(PARTS), runs.width
    side, step = runs.least - runs.gram, runs.least - finer.gram + 1
    digest = xxhash.xxh3_64_intdigest

    def signed(values: list[int]) -> np.ndarray:
        return np.array(values, np.uint64).view(np.int64)

    def emit(batches):
        for b in batches:
            out = []
            for doc_id, key, pos, start, context in zip(
                *[b.column(c).to_pylist() for c in ("doc_id", "key", "pos", "start", "context")],
                strict=True,
            ):
                total = len(context) // w
                for near in range(0, side + 1, step):  # least distance from a run's start
                    at = pos - near - start  # of the finer gram, in the context
                    low = max(0, at - min(step - 1, side - near))
                    high = min(total, at + runs.least)
                    if at < 0 or high - low < runs.least:
                        continue  # no run of the part lies in the document
                    part = context[low * w : high * w]
                    gram = context[at * w : (at + finer.gram) * w]
                    out.append((digest(gram), digest(part, at - low), doc_id, start + at, key,
                                start + low, start + high, part))
            columns = list(zip(*out, strict=True)) or [()] * len(schema)
            yield batch(schema, [signed(columns[0]), signed(columns[1]), *columns[2:]])

    return hot.select("doc_id", "key", "pos", "start", "context").mapInArrow(emit, PARTS)


def resolve(
    docs: DataFrame,
    runs: Runs,
    grams: list[int],
    compare: Callable[[DataFrame, int], DataFrame],
    later_only: bool,
    store: Staging,
) -> list[DataFrame]:
    """Spans of repeated runs; they may overlap.

    ``compare(contexts, gram)`` finds repeats among different contexts of one anchor. ``later_only``
    leaves the first place of a run out, and else all places of a repeated run count. ``grams`` are
    the longer grams hot anchors are taken apart by; the last one is a whole run.
    """
    found = store(occurrences(docs, runs), "occurrences")
    grouped = store(classes(found), "classes")
    spans = [store(whole_contexts(_members(found, grouped, later_only), runs), "spans")]
    contexts = store(shipped(docs, grouped.filter("contexts > 1"), runs), "contexts")
    for gram in [*grams, None]:
        spans.append(store(compare(contexts.filter("NOT hot"), runs.gram), "spans"))
        hot = contexts.filter("hot")
        if gram is None or hot.isEmpty():
            return spans
        finer = replace(runs, gram=gram)
        # Anchors close to each other can give a document's part twice; a place counts once.
        once = ["anchor", "digest", "doc_id", "key", "pos"]
        parts = store(_parts(hot, runs, finer).dropDuplicates(once), "parts")
        first = F.struct("doc_id", "pos", "key", "start")
        each = parts.groupBy("anchor", "digest").agg(
            F.count("*").alias("n"),
            F.min(first).alias("first"),
            F.min_by("context", first).alias("context"),
        )
        each = store(each, "part_classes")
        several = _per_anchor(each, F.count("*").alias("contexts")).filter("contexts > 1")
        members = _members(parts, each, later_only)
        spans.append(store(members.select("doc_id", "key", "start", "end"), "spans"))
        contexts = store(
            each.join(several, "anchor").select(
                (F.col("contexts") > runs.most).alias("hot"), "anchor", "first.doc_id",
                "first.key", "first.pos", "first.start", "context",
            ),
            "contexts",
        )
        runs = finer
    return spans


def _members(found: DataFrame, grouped: DataFrame, later_only: bool) -> DataFrame:
    """Places in classes of several, without the first place of each if asked."""
    joined = found.join(
        grouped.filter("n > 1").select("anchor", "digest", "first"), ["anchor", "digest"]
    )
    if not later_only:
        return joined
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("pos") == F.col("first.pos")
    )
    return joined.filter(~is_first)


def by_anchor(batches, names: list[str]):
    """Rows of consecutive equal ``anchor`` from the batches of a sorted partition, as lists."""
    group, anchor = [], None
    for b in batches:
        for row in zip(*[b.column(c).to_pylist() for c in names], strict=True):
            if row[0] != anchor:
                if group:
                    yield group
                group, anchor = [], row[0]
            group.append(row)
    if group:
        yield group


SPANS = fields(("doc_id", "long"), ("key", "long"), ("start", "long"), ("end", "long"))


def whole_contexts(members: DataFrame, runs: Runs) -> DataFrame:
    """Spans of the full context of given occurrences."""
    side = runs.least - runs.gram
    return members.select(
        "doc_id",
        "key",
        F.greatest(F.lit(0), F.col("pos") - side).alias("start"),
        F.least("units", F.col("pos") + runs.least).alias("end"),
    )


def spans_by_document(docs: DataFrame, spans: list[DataFrame], store: Staging) -> DataFrame:
    """(doc_id, text, starts, ends) of every row of ``docs``; spans may overlap."""
    every = spans[0]
    for more in spans[1:]:
        every = every.unionAll(more)
    listed = every.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(
        F.collect_set(F.struct("start", "end")).alias("spans")
    )
    return (
        docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))
        .join(
            listed,
            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")),
            "left",
        )
        .select(
            "doc_id",
            "text",
            F.col("spans.start").alias("starts"),
            F.col("spans.end").alias("ends"),
        )
    )


def merged(starts: list[int] | None, ends: list[int] | None) -> list[tuple[int, int]]:
    """Overlapping and touching spans as maximal ones."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts or [], ends or [], strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
