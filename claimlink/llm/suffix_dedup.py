"""Suffix-array dedup: every byte covered by a 400-byte string that starts twice anywhere goes.

Winnowed anchors (``repeats``) say where repeated strings can lie and bring their contexts
together: all contexts of an anchor reach the same shard. A shard, a megabyte or so, concatenates its
contexts, sorts all its suffixes by induced sorting (``suffix_array``) and computes permuted common
prefixes; a place whose suffix shares ``least`` bytes with a neighbour in the array, inside its own
context, starts a repeated string. Contexts that occur several times as a whole are repeated by
that alone; they take part in the shard once.

Defined results: a null text is empty. Matches never cross documents, and strings are judged on
the input. Texts shorter than ``least`` keep all. Overlapping occurrences in one document count, and
so do repeated rows. Ids may be null or repeated: rows with equal id and text get equal results.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from claimlink.llm.common import arrow_schema, batch, fields, staging, texts
from claimlink.llm.repeats import (
    SPANS,
    Runs,
    by_anchor,
    merged,
    resolve,
    smallest_of_windows,
    spans_by_document,
)
from claimlink.llm.suffix_array import common_prefixes, suffix_array

LEAST_BYTES = 400
GRAM_BYTES = 300
HOT_CONTEXTS = 1_000  # half a shard
SHARD_BYTES = 1_000_000
SEGMENT = 1 << 19
SEPARATOR = 255  # occurs in no UTF-8 text

_FACTOR = 0x9E3779B97F4A7C15
_SYMBOLS = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(n: int, factor: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def byte_runs(
    least: int = LEAST_BYTES, gram: int = GRAM_BYTES, most: int = HOT_CONTEXTS
) -> Runs:
    tables = {}

    def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
        positions, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        if not tables:
            size = SEGMENT + least + 1
            tables["up"] = _powers(size, _FACTOR)
            tables["down"] = _powers(size, pow(_FACTOR, -1, 1 << 64))
        for at in range(0, len(text) - least + 1, SEGMENT):  # runs that start in the segment
            x = np.frombuffer(text, np.uint8)[at : at + SEGMENT + least - 1]
            sums = np.zeros(len(x) + 1, np.uint64)
            np.cumsum(_SYMBOLS[x] * tables["up"][: len(x)], out=sums[1:])
            h = (sums[gram:] - sums[:-gram]) * tables["down"][: len(x) - gram + 1]
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            p = smallest_of_windows(h, least - gram + 1)
            positions.append(p + at)
            hashes.append(h[p])
        positions, hashes = np.concatenate(positions), np.concatenate(hashes)
        _, once = np.unique(positions, return_index=True)  # a segment's edge may give one twice
        return positions[once], hashes[once]

    return Runs(least, gram, 1, lambda text: text, anchors, most)


def repeated_starts(contexts: list[tuple], least: int) -> list[tuple]:
    """(doc_id, key, start, end) of repeated strings in one shard.

    A context is (anchor, doc_id, key, start, bytes). Contexts of one document that overlap are laid
    over each other first, so a place is in the shard once.
    """
    contexts = sorted(
        {c[1:] for c in contexts}, key=lambda c: (c[0] is not None, c[0] or 0, *c[1:3])
    )
    parts: list[list] = []  # doc_id, key, start, bytes
    for doc_id, key, start, text in contexts:
        last = parts[-1] if parts else None
        if last and last[:2] == [doc_id, key] and start < last[2] + len(last[3]):
            last[3] += text[max(0, last[2] + len(last[3]) - start) :]
        else:
            parts.append([doc_id, key, start, bytearray(text)])
    joined = bytearray()
    for p in parts:
        joined += p[3]
        joined.append(SEPARATOR)
    text = np.frombuffer(bytes(joined), np.uint8)
    before, prefix = common_prefixes(text, suffix_array(text))
    long = np.flatnonzero(prefix >= least)
    repeated = np.zeros(len(text) + 1, bool)
    repeated[long] = True
    repeated[before[long]] = True
    out, at = [], 0
    for doc_id, key, start, own in parts:
        here = repeated[at : at + max(0, len(own) - least + 1)]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], here.view(np.int8), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            out.append((doc_id, key, start + a, start + b - 1 + least))
        at += len(own) + 1
    return out


def repeated_spans(
    docs: DataFrame,
    least: int = LEAST_BYTES,
    gram: int = GRAM_BYTES,
    most: int = HOT_CONTEXTS,
    shard_bytes: int = SHARD_BYTES,
) -> list[DataFrame]:
    """Spans (may overlap) that cover exactly the bytes of repeated strings."""
    store, runs = staging(docs.sparkSession), byte_runs(least, gram, most)
    names = ["anchor", "doc_id", "key", "start", "context"]
    schema = arrow_schema(SPANS)

    def shards(batches):
        waiting, size = [], 0

        def settle():
            rows = repeated_starts(waiting, least)
            for at in range(0, len(rows), 10_000):
                yield batch(schema, list(zip(*rows[at : at + 10_000], strict=True)))

        for group in by_anchor(batches, names):
            waiting += group
            size += sum(len(row[-1]) for row in group)
            if size >= shard_bytes:
                yield from settle()
                waiting, size = [], 0
        if waiting:
            yield from settle()

    def compare(contexts: DataFrame, _: int) -> DataFrame:
        return (
            contexts.select(*names)
            .repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(shards, SPANS)
        )

    side = least - gram
    grams = [least - side // 5, least - side // 25, least]
    return resolve(docs, runs, grams, compare, later_only=False, store=store)


REMOVED = fields(
    ("doc_id", "long"), ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"),
    ("kept_sha256", "string"),
)


def remove_repeats(
    docs: DataFrame,
    least: int = LEAST_BYTES,
    gram: int = GRAM_BYTES,
    most: int = HOT_CONTEXTS,
) -> DataFrame:
    """Sizes, removed spans and the digest of what remains, for every document."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    store = staging(docs.sparkSession)
    schema = arrow_schema(REMOVED)

    def cut(batches):
        for b in batches:
            rows = []
            for text, starts, ends in zip(
                texts(b.column("text")), b.column("starts").to_pylist(),
                b.column("ends").to_pylist(), strict=True,
            ):
                spans, digest, at = merged(starts, ends), hashlib.sha256(), 0
                for start, end in spans:
                    digest.update(text[at:start])
                    at = end
                digest.update(text[at:])
                rows.append((len(text), sum(e - s for s, e in spans), len(spans),
                             digest.hexdigest()))
            yield batch(schema, [b.column("doc_id"), *(list(zip(*rows, strict=True)) or [()] * 4)])

    spans = repeated_spans(docs, least, gram, most)
    return spans_by_document(docs, spans, store).mapInArrow(cut, REMOVED)
