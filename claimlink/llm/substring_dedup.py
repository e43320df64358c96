"""Substring dedup: seed and extend over runs of 20 words.

Seeds are winnowed anchors of ten words (``repeats``). Documents meet on equal anchors; from the
seed, matches are extended word by word to the left and to the right against the earlier places of
the same anchor, and what reaches 20 words is kept as a maximal repeat. A word goes if a run that
covers it starts earlier in the corpus: in a smaller document id, or earlier in the same document.
Equal contexts are one class, whose first member alone is extended; the others are repeats of it.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a null text has none. Runs are
judged on the input. Null ids come before all others. Rows that repeat an id count as one document:
a place is not earlier than itself. Extra columns are not read. Words are compared by 64-bit
hashes, equal contexts by 64-bit digests under their anchor's.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from claimlink.llm.common import arrow_schema, batch, fields, staging, texts, words
from claimlink.llm.decontaminate import shingle_hashes, word_hashes
from claimlink.llm.repeats import (
    SPANS,
    Runs,
    by_anchor,
    merged,
    resolve,
    smallest_of_windows,
    spans_by_document,
)

LEAST_WORDS = 20
GRAM_WORDS = 10
HOT_CONTEXTS = 256


def word_runs(
    least: int = LEAST_WORDS, gram: int = GRAM_WORDS, most: int = HOT_CONTEXTS
) -> Runs:
    def units(text: bytes) -> bytes:
        return word_hashes(words(text)).tobytes()

    def anchors(unit: bytes) -> tuple[np.ndarray, np.ndarray]:
        h = shingle_hashes(np.frombuffer(unit, np.uint64), gram)
        p = smallest_of_windows(h, least - gram + 1)
        return p, h[p]

    return Runs(least, gram, 8, units, anchors, most)


def _common(rows: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Per row, how many of its first words equal those of ``own``; 0 pads what is missing."""
    return np.cumprod((rows == own) & (rows != 0), axis=1, dtype=np.int8).sum(1)


def extended(group: list[tuple], least: int, gram: int) -> list[tuple]:
    """(doc_id, key, start, end) of the maximal repeats of earlier places in one anchor's contexts.

    A context is (anchor, doc_id, key, pos, start, bytes of word hashes).
    """
    group = sorted(set(group), key=lambda r: (r[1] is not None, r[1] or 0, r[3], r[2]))
    side = least - gram
    left = np.zeros((len(group), side), np.uint64)
    right = np.zeros((len(group), side), np.uint64)
    for i, (_, _, _, pos, start, context) in enumerate(group):
        unit = np.frombuffer(context, np.uint64)
        unit = np.where(unit == 0, np.uint64(1), unit)
        before, after = unit[: pos - start][::-1], unit[pos - start + gram :]
        left[i, : len(before)] = before
        right[i, : len(after)] = after
    out = []
    for i in range(1, len(group)):
        _, doc_id, key, pos, start, _ = group[i]
        earlier = i
        while earlier and group[earlier - 1][1] == doc_id and group[earlier - 1][3] == pos:
            earlier -= 1  # the same place, in a row with the same id
        if not earlier:
            continue
        to_left = _common(left[:earlier], left[i])
        to_right = _common(right[:earlier], right[i])
        enough = to_left + to_right >= side
        for a, b in {*zip(to_left[enough].tolist(), to_right[enough].tolist(), strict=True)}:
            out.append((doc_id, key, pos - a, pos + gram + b))
    return out


def later_spans(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    gram: int = GRAM_WORDS,
    most: int = HOT_CONTEXTS,
) -> list[DataFrame]:
    """Spans of words (may overlap) that repeat earlier runs."""
    store, runs = staging(docs.sparkSession), word_runs(least, gram, most)
    names = ["anchor", "doc_id", "key", "pos", "start", "context"]
    schema = arrow_schema(SPANS)

    def compare(contexts: DataFrame, gram: int) -> DataFrame:
        def extend(batches):
            rows = []
            for group in by_anchor(batches, names):
                rows += extended(group, least, gram)
                if len(rows) >= 10_000:
                    yield batch(schema, list(zip(*rows, strict=True)))
                    rows = []
            if rows:
                yield batch(schema, list(zip(*rows, strict=True)))

        return (
            contexts.select(*names)
            .repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(extend, SPANS)
        )

    grams = [least - (least - gram) // 4, least]
    return resolve(docs, runs, grams, compare, later_only=True, store=store)


REMOVED = fields(
    ("doc_id", "long"), ("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")
)


def remove_later_repeats(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    gram: int = GRAM_WORDS,
    most: int = HOT_CONTEXTS,
) -> DataFrame:
    """Words, removed words and the digest of what remains, for every document."""
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
                tokens = words(text)
                spans, kept, at = merged(starts, ends), [], 0
                for start, end in spans:
                    kept += tokens[at:start]
                    at = end
                kept += tokens[at:]
                rows.append((len(tokens), len(tokens) - len(kept),
                             hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield batch(schema, [b.column("doc_id"), *(list(zip(*rows, strict=True)) or [()] * 3)])

    spans = later_spans(docs, least, gram, most)
    return spans_by_document(docs, spans, store).mapInArrow(cut, REMOVED)
