"""SimHash near-duplicates found in BK-trees.

A document's 64-bit fingerprint has a bit set where over half of its shingle hashes have it. Equal
fingerprints collapse to one row first, so exact copies never meet. Fingerprints that differ in at
most ``distance`` bits agree on all but ``distance`` of ``BLOCKS`` blocks of bits: each fingerprint
goes to one shard per choice of agreeing blocks, and a shard's members differ in the bits of the
other blocks only, which bounds their number (16 bits, 65,536 members, for two bits of distance)
however many near copies the corpus holds. In a shard, a BK-tree hangs every fingerprint below its
parent by integer Hamming distance; a search follows only edges within the radius. What a task
finds it joins into sets and emits one link per member, never all pairs; components of these links
are the groups.

Shard trees are built where their shuffle partition lands and are not broadcast: together they hold
the fingerprints of all documents, which must not pass through the driver.

Defined results: texts are lower-cased (A-Z); fewer words than a shingle give one shingle, no words
(null, empty, blank) the fingerprint zero, which links like any other. ``component_id`` is the
smallest document id of the group, null if all its ids are null. Repeated rows get equal results.
``keep_one_each`` keeps one row of each group, of the smallest id; rows that share an id are judged
by their own group each, rows without an id are not judged and stay.
Extra columns pass through it and are not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlink.llm.common import arrow_schema, batch, fields, fresh, staging, texts, words
from claimlink.llm.graph import components
from claimlink.sources.tables import Staging

SHINGLE_WORDS = 3
DISTANCE = 2
SEED = 42
BLOCKS = 8
_BITS = np.arange(64, dtype=np.uint64)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    tokens = words(text.lower())
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    n = max(len(tokens) - size + 1, 1)
    starts = np.cumsum([0, *map(len, tokens)]) + np.arange(len(tokens) + 1)
    begin = starts[:n].tolist()
    end = (starts[min(size, len(tokens)) :] - 1)[:n].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(begin, end, strict=True)]
    return np.array(hashes, np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; zero for none."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 100_000):
        some = hashes[at : at + 100_000].astype("<u8")
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.bitwise_or.reduce((2 * counts > len(hashes)).astype(np.uint64) << _BITS))


PRINTS = fields(("doc_id", "long"), ("print", "long"))


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, print); ``print`` is the fingerprint as a signed long."""
    schema = arrow_schema(PRINTS)

    def measure(batches):
        for b in batches:
            prints = [fingerprint(shingle_hashes(t, size)) for t in texts(b.column("text"))]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield batch(schema, [b.column("doc_id"), signed])

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(measure, PRINTS)


# ---------------------------------------------------------------- BK-trees
class Tree:
    """Children keyed by their distance to the parent."""

    def __init__(self, root: int):
        self.values = [root]
        self.children: list[dict[int, int]] = [{}]

    def add(self, value: int) -> None:
        at = 0
        while True:
            d = (self.values[at] ^ value).bit_count()
            if d == 0:
                return
            child = self.children[at].get(d)
            if child is None:
                self.children[at][d] = len(self.values)
                self.values.append(value)
                self.children.append({})
                return
            at = child

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Values within the radius; only edges from d - radius to d + radius are followed."""
        todo = [0]
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                yield self.values[at]
            children = self.children[at]
            for edge in range(d - radius, d + radius + 1):
                if edge in children:
                    todo.append(children[edge])


class Sets:
    """Disjoint sets of numbers, each named by its smallest."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def link_shard(members: list[int], radius: int, sets: Sets) -> None:
    """Join the members (distinct) that are within the radius of each other, along the tree."""
    if len(members) == 2:
        if (members[0] ^ members[1]).bit_count() <= radius:
            sets.join(*members)
        return
    tree = Tree(members[0])
    for value in members[1:]:
        for other in tree.near(value, radius):
            sets.join(value, other)
        tree.add(value)


def shard_masks(distance: int = DISTANCE, blocks: int = BLOCKS) -> list[int]:
    """For every choice of ``distance`` blocks that may differ, the bits of the others."""
    width = 64 // blocks
    block = [((1 << width) - 1) << (width * k) for k in range(blocks)]
    everything = (1 << 64) - 1
    return [everything ^ sum(c) for c in combinations(block, distance)]


LINKS = fields(("a", "long"), ("b", "long"))
KEPT_SETS = 100_000


def near_links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Links (a, b) that join distinct prints within the distance; not every pair, but no group is
    left in two."""
    masks = [m - (1 << 64) if m >> 63 else m for m in shard_masks(distance, blocks)]
    schema = arrow_schema(LINKS)
    keyed = prints.select(
        "print",
        F.explode(
            F.array(*[
                F.struct(F.lit(k).alias("choice"), F.col("print").bitwiseAND(m).alias("common"))
                for k, m in enumerate(masks)
            ])
        ).alias("shard"),
    ).select("shard.choice", "shard.common", "print")

    def search(batches):
        sets, key, members = Sets(), None, []

        def links():
            some = [(x, sets.find(x)) for x in sets.parent]
            some = [(x, r) for x, r in some if x != r]
            for at in range(0, len(some), 50_000):
                a, b = zip(*some[at : at + 50_000], strict=True)
                signed = [np.array(v, np.uint64).view(np.int64) for v in (a, b)]
                yield batch(schema, signed)

        for b in batches:
            choice = b.column("choice").to_numpy()
            common = b.column("common").to_numpy()
            prints = b.column("print").to_numpy().view(np.uint64)
            if not len(prints):
                continue
            new = np.flatnonzero(
                np.append(True, (choice[1:] != choice[:-1]) | (common[1:] != common[:-1]))
            )
            ends = np.append(new[1:], len(prints))
            for start, end in zip(new.tolist(), ends.tolist(), strict=True):
                this = (choice[start], common[start])
                if this == key:
                    members += prints[start:end].tolist()
                    continue
                if len(members) > 1:
                    link_shard(members, distance, sets)
                key, members = this, prints[start:end].tolist()
            if len(sets.parent) > KEPT_SETS:  # bounded memory; links of the rest follow
                yield from links()
                sets.parent.clear()
        if len(members) > 1:
            link_shard(members, distance, sets)
        yield from links()

    return (
        keyed.repartition("choice", "common")
        .sortWithinPartitions("choice", "common")
        .mapInArrow(search, LINKS)
    )


def _grouped(
    docs: DataFrame, size: int, distance: int, blocks: int, store: Staging
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print) of every row; (print, root, component_id) of every fingerprint."""
    prints = store(fingerprints(docs, size), "prints")
    first = prints.groupBy("print").agg(F.min("doc_id").alias("first"))
    links = store(near_links(first.select("print"), distance, blocks), "links")
    rooted = components(links, store).withColumnRenamed("node", "print")
    grouped = first.join(rooted, "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = grouped.join(smallest, "root").select("print", "root", "component_id")
    return prints, store(named, "groups")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE, blocks: int = BLOCKS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    prints, named = _grouped(docs, size, distance, blocks, staging(docs.sparkSession))
    return prints.join(named, "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_each(
    docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE, blocks: int = BLOCKS
) -> DataFrame:
    """The documents without all but one of every group."""
    store = staging(docs.sparkSession)
    other_id, own_print, root, component = fresh(docs, "id", "print", "root", "component")
    prints, named = _grouped(docs, size, distance, blocks, store)
    known = prints.filter("doc_id IS NOT NULL")
    same_id = docs["doc_id"].cast("long") == F.col(other_id)
    dropped = store(
        known.join(named, "print")
        .filter("component_id < doc_id")
        .select(F.col("doc_id").alias(other_id)).distinct(),
        "dropped",
    )
    ids = known.groupBy(F.col("doc_id").alias(other_id)).agg(F.count(F.lit(1)).alias("rows"))
    twice = ids.filter("rows > 1").select(other_id)
    if twice.isEmpty():
        return docs.join(dropped, same_id, "left_anti")
    # Rows that share an id are judged by their own text's group, and each group keeps one row.
    twice = store(twice, "twice")
    once = docs.join(twice, same_id, "left_anti").join(dropped, same_id, "left_anti")
    groups = named.select(
        F.col("print").alias(own_print), F.col("root").alias(root),
        F.col("component_id").alias(component),
    )
    several = (
        _with_prints(docs.join(twice, same_id, "left_semi"), size, own_print)
        .join(groups, own_print)
        .filter(F.col("doc_id").cast("long") == F.col(component))
        .dropDuplicates([root])
    )
    return once.unionAll(several.select(*docs.columns))


def _with_prints(docs: DataFrame, size: int, name: str) -> DataFrame:
    """The documents and their fingerprint under ``name``."""
    out = T.StructType([*docs.schema, T.StructField(name, T.LongType())])

    def measure(batches):
        for b in batches:
            prints = [fingerprint(shingle_hashes(t, size)) for t in texts(b.column("text"))]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, signed], [*b.schema.names, name])

    return docs.mapInArrow(measure, out)
