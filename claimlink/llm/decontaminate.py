"""Benchmark decontamination: short test items found inside long documents.

Similarity is containment: the share of an item's distinct shingles (five words, ASCII letters
lower-cased) that occur anywhere in the document, at least 0.8. Items are partitioned by their
number of shingles. A partition's MinHash sketch of an item is its smallest hash values, as many as
the partition's size demands: a document that holds 80 % of n shingles cannot miss more than n/5 of
them, so it holds at least one of the n/5 + 1 smallest. A document is a candidate for every item of
which it holds a sketch value; exact shingles then decide. Nothing is lost to chance.

Documents never move: every task hashes its own texts and meets the items, which it gets in blocks
of bounded size; a benchmark beyond one block takes several passes. Each pass stores what it found
before the next block is made, so the driver holds one block, whatever the benchmark.

Defined results: a null text has no words. An item of one to four words is one shingle, its whole
word sequence; an item without words, or with a null id, contains nothing and is left out. Repeated
documents are each reported; repeated items count once per (id, text). An empty table gives no
pairs. Extra columns pass through ``decontaminate`` and are not read otherwise.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlink.llm.common import arrow_schema, batch, fields, fresh, staging, texts, words

SHINGLE_WORDS = 5
THRESHOLD = "0.8"
BLOCK_WORDS = 1_000_000  # of the items a task holds at a time
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words, from the words' hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _FACTOR
        out ^= out >> np.uint64(29)
        out += hashes[k : k + n]
    out *= _FACTOR
    out ^= out >> np.uint64(32)
    return out


def shingles(tokens: list[bytes], size: int) -> list[bytes]:
    return [b" ".join(tokens[i : i + size]) for i in range(len(tokens) - size + 1)]


@dataclass
class Item:
    item_id: int
    size: int  # words of a shingle
    exact: dict[int, set[bytes]]  # shingles by hash
    count: int


@dataclass
class Items:
    """A block of items: sketches by shingle size as sorted arrays, and who stands behind them."""

    items: list[Item]
    sketch: dict[int, np.ndarray]
    owners: dict[int, dict[int, list[int]]]
    least: Fraction


def sketch_size(count: int, least: Fraction) -> int:
    """Of an item in the partition of sizes up to the next power of two, taken at its own bound."""
    bound = 1 << max(0, count - 1).bit_length()
    return min(count, bound - math.ceil(least * bound) + 1)


def prepare_items(rows, size: int = SHINGLE_WORDS, threshold: str = THRESHOLD) -> Items:
    least = Fraction(threshold)
    items, sketch, owners = [], defaultdict(list), defaultdict(lambda: defaultdict(list))
    for item_id, text in rows:
        tokens = words((text or "").encode().lower())
        if not tokens:
            continue
        k = min(size, len(tokens))
        exact = defaultdict(set)
        for h, s in zip(
            shingle_hashes(word_hashes(tokens), k).tolist(), shingles(tokens, k), strict=True
        ):
            exact[h].add(s)
        count = sum(map(len, exact.values()))
        number = len(items)
        items.append(Item(item_id, k, dict(exact), count))
        for h in sorted(exact)[: sketch_size(count, least)]:
            sketch[k].append(h)
            owners[k][h].append(number)
    return Items(
        items,
        {k: np.unique(np.array(v, np.uint64)) for k, v in sketch.items()},
        {k: dict(v) for k, v in owners.items()},
        least,
    )


def contained(text: bytes, block: Items) -> list[tuple[int, int, int]]:
    """(item, its shingles, those in the text) of the items the text contains."""
    tokens = words(text.lower())
    hashes = word_hashes(tokens)
    found = []
    for size, sketch in block.sketch.items():
        own = shingle_hashes(hashes, size)
        if not len(own):
            continue
        place = np.searchsorted(sketch, own)
        place[place == len(sketch)] = 0
        hits = set(own[sketch[place] == own].tolist())
        candidates = {i for h in hits for i in block.owners[size][h]}
        if not candidates:
            continue
        wanted = np.array(sorted({h for i in candidates for h in block.items[i].exact}), np.uint64)
        place = np.searchsorted(wanted, own)
        place[place == len(wanted)] = 0
        there = defaultdict(set)
        for p in np.flatnonzero(wanted[place] == own).tolist():
            there[int(own[p])].add(b" ".join(tokens[p : p + size]))
        for i in sorted(candidates):
            item = block.items[i]
            n = sum(len(s & there[h]) for h, s in item.exact.items() if h in there)
            if n >= block.least * item.count:
                found.append((i, item.count, n))
    return found


def item_blocks(
    benchmark: DataFrame, block_words: int = BLOCK_WORDS
) -> tuple[int, Iterator[list[tuple]]]:
    """Number of blocks of about ``block_words`` words, and the blocks, one at a time."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").dropna().distinct()
    size = F.size(F.split("text", "[\x20\x09-\x0d]+"))
    total = items.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first().n
    blocks = max(1, math.ceil(total / block_words))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))

    def each():
        for k in range(blocks):
            rows = items.filter(number == k).sort("item_id", "text").collect()
            yield [(r.item_id, r.text) for r in rows]

    return blocks, each()


PAIRS = fields(
    ("doc_id", "long"),
    ("item_id", "long"),
    ("n_shingles", "long"),
    ("n_contained", "long"),
    ("containment", "double"),
)
BAD = fields(("digest", "string"))


def contaminated_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SHINGLE_WORDS,
    threshold: str = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every (document, item) with containment of at least ``threshold``."""
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    schema = arrow_schema(PAIRS)
    store = staging(docs.sparkSession)
    blocks, each = item_blocks(benchmark, block_words)

    def found(block: Items) -> DataFrame:
        def search(batches):
            for b in batches:
                out = []
                ids = b.column("doc_id").to_pylist()
                for doc_id, text in zip(ids, texts(b.column("text")), strict=True):
                    for i, count, n in contained(text, block):
                        out.append((doc_id, block.items[i].item_id, count, n, n / count))
                yield batch(schema, list(zip(*out, strict=True)) or [()] * 5)

        return chosen.mapInArrow(search, PAIRS)

    if blocks == 1:
        return found(prepare_items(next(each), size, threshold))
    passes = [store(found(prepare_items(rows, size, threshold)), "pairs") for rows in each]
    return reduce(DataFrame.unionAll, passes)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SHINGLE_WORDS,
    threshold: str = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents that contain no item."""
    store = staging(docs.sparkSession)
    blocks, each = item_blocks(benchmark, block_words)
    if blocks == 1:
        block = prepare_items(next(each), size, threshold)

        def keep(batches):
            for b in batches:
                clean = [not contained(t, block) for t in texts(b.column("text"))]
                yield b.filter(pa.array(clean, pa.bool_()))

        return docs.mapInArrow(keep, docs.schema)
    digest = F.sha2(docs["text"], 256)
    passes = [
        store(_texts_with(docs.select("text"), prepare_items(rows, size, threshold)), "bad")
        for rows in each
    ]
    (name,) = fresh(docs, "bad_digest")
    bad = reduce(DataFrame.unionAll, passes).distinct().toDF(name)
    return docs.join(bad, digest == F.col(name), "left_anti")


def _texts_with(docs: DataFrame, block: Items) -> DataFrame:
    """SHA-256 of the texts that contain an item of the block."""
    schema = arrow_schema(BAD)

    def search(batches):
        for b in batches:
            bad = [hashlib.sha256(t).hexdigest() for t in texts(b.column("text"))
                   if contained(t, block)]
            yield batch(schema, [bad])

    return docs.mapInArrow(search, BAD)
