"""Statistics of whole texts, and a lexicon of words that mark unwanted ones.

Everything is counted per document over its whole text in one pass; nothing is sampled but the
labelled rows a lexicon or model is fitted on, at most ``MAX_LABELLED``, chosen by hash of the id.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.llm.common import arrow_schema, batch, fields, texts, words

MAX_LABELLED = 20_000
MAX_LEXICON = 5_000
COUNTED_KEYS = 100_000  # a task holds at a time
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_PUNCTUATION = b".,;:!?\"'()[]{}-"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def n_repeat_words(tokens: list[bytes], size: int = WINDOW) -> int:
    """Words in windows of ``size`` words that occur twice or more in the text."""
    n = len(tokens) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    window = h[:n].copy()
    for k in range(1, size):
        window *= _FACTOR
        window ^= window >> np.uint64(29)
        window += h[k : k + n]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    place = np.searchsorted(twice, window)
    place[place == len(twice)] = 0
    starts = np.flatnonzero(twice[place] == window)
    edge = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def n_dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct_words", "n_doubled_words", "n_digits", "n_flagged"]


def lexicon_keys(word: bytes) -> tuple[bytes, ...]:
    """What a lexicon knows of a word: itself and how it begins, without case and punctuation."""
    bare = word.lower().strip(_PUNCTUATION)
    return (bare, bare[:4] + b"*", bare[:5] + b"*") if len(bare) > 4 else (bare,)


def count_flagged(frequency: Counter[bytes], lexicon: frozenset[bytes]) -> int:
    if not lexicon:
        return 0
    return sum(n for w, n in frequency.items() if any(k in lexicon for k in lexicon_keys(w)))


def counts(text: bytes, lexicon: frozenset[bytes] = frozenset()) -> list[int]:
    """``COUNTS`` and ``MORE`` of one text. ``bytes.isspace`` and ``split`` know the same six
    blanks."""
    tokens = words(text)
    joined = b"".join(tokens)
    frequency = Counter(tokens)
    return [
        len(tokens),
        len(joined.translate(None, _CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        n_dup_lines(text),
        n_repeat_words(tokens),
        text.count(b"\n") + 1 if tokens else 0,
        len(frequency),
        sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)),
        len(text) - len(text.translate(None, b"0123456789")),
        count_flagged(frequency, lexicon),
    ]


STATS = fields(("doc_id", "long"), *[(c, "long") for c in COUNTS + MORE])


def document_stats(docs: DataFrame, lexicon: frozenset[bytes] = frozenset()) -> DataFrame:
    """``doc_id`` and all counts, one row per row of ``docs``."""
    schema = arrow_schema(STATS)

    def measure(batches):
        for b in batches:
            rows = [counts(t, lexicon) for t in texts(b.column("text"))]
            columns = list(zip(*rows, strict=True)) or [()] * (len(schema) - 1)
            yield batch(schema, [b.column("doc_id"), *columns])

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(measure, STATS)


def ratios() -> dict[str, Column]:
    """Features as expressions over the counts; a text without words has all zero."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / n,
        "distinct_share": F.col("n_distinct_words") / n,
        "doubled_share": F.col("n_doubled_words") / n,
        "digits_per_word": F.col("n_digits") / n,
        "flagged_share": F.col("n_flagged") / n,
        "flagged_words": F.col("n_flagged").cast("double"),
    }


def labelled_ids(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, bad) of at most ``most`` labelled documents.

    ``bad`` is 1 for quality 0 or toxic 1. A document labelled differently in several rows counts
    as bad; labels without a document, a null id, or a null quality and not toxic 1 are left out.
    """
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    judged = (
        labels.filter(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | (toxic == 1)))
        .select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.col("quality") == 0, F.lit(False)) | (toxic == 1))
            .cast("int").alias("bad"),
        )
        .groupBy("doc_id")
        .agg(F.max("bad").alias("bad"))
    )
    present = docs.select(docs["doc_id"].cast("long").alias("doc_id")).distinct()
    return (
        judged.join(present, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


WORDS = fields(("key", "binary"), ("good", "long"), ("bad", "long"))


def learn_lexicon(
    docs: DataFrame,
    sample: dict[int, int],
    most: int = MAX_LEXICON,
    least_documents: int = 5,
    least_odds: float = 3.0,
) -> frozenset[bytes]:
    """Words and word beginnings far more frequent in bad documents than in good ones.

    ``sample`` maps the ids of the labelled sample to 1 for bad. Documents holding a key are
    counted; the log odds must reach ``least_odds``. The result is bounded by ``most``.
    """
    n_bad = sum(sample.values())
    n_good = len(sample) - n_bad
    if not n_bad or not n_good:
        return frozenset()
    schema = arrow_schema(WORDS)

    def count(batches):
        good, bad = Counter(), Counter()

        def flush():
            keys = list(good.keys() | bad.keys())
            for at in range(0, len(keys), 10_000):
                some = keys[at : at + 10_000]
                yield batch(schema, [some, [good[k] for k in some], [bad[k] for k in some]])
            good.clear()
            bad.clear()

        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for i, text in zip(ids, texts(b.column("text")), strict=True):
                keys = {k for w in set(words(text)) for k in lexicon_keys(w)}
                (bad if sample.get(i) else good).update(keys)
                if len(good) + len(bad) > COUNTED_KEYS:  # the sums follow; memory stays bounded
                    yield from flush()
        yield from flush()

    ids = docs.sparkSession.createDataFrame([(i,) for i in sample], "doc_id long")
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").join(
        F.broadcast(ids), "doc_id", "left_semi"  # at most MAX_LABELLED rows
    )
    summed = (
        chosen.mapInArrow(count, WORDS)
        .groupBy("key")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    )
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    rows = (
        summed.filter((F.col("bad") >= least_documents) & (odds >= least_odds))
        .orderBy(odds.desc(), "key")
        .limit(most)
        .collect()
    )
    return frozenset(bytes(r.key) for r in rows)

