"""Quality classifier by co-training on two views of a document.

One classifier sees the text (counts, and words that mark bad labelled texts), the other the
page's metadata (language, source, length; how many documents a source has is not counted). Each
starts from the labelled documents. In every round each view scores all unlabelled documents and
hands those it is certain of to the other view as pseudo-labels, at most ``MAX_PSEUDO`` by hash of
the id; certain means a calibrated probability beyond ``CONFIDENT`` on either side. At last
both scores are calibrated on held-out labels and combined, and every document is scored.

Both views are logistic models over binned features, fitted on the driver on at most
``MAX_LABELLED`` labelled and, per round, ``MAX_PSEUDO`` pseudo-labelled rows. Statistics,
candidate scores and final scores cover all documents.

Defined results: a null text has no words; null metadata is a value of its own. Without labels, or
with one class only, the score is 0.5 and all documents are kept. Repeated rows are scored alike
and each returned; null ids are scored, too. Of a labelled id with several texts the row with the
smallest features is fitted. Extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlink.llm.common import arrow_schema, batch, fields, staging, texts
from claimlink.llm.text_stats import MAX_LABELLED, counts, labelled_ids, learn_lexicon
from claimlink.operators.sieve import sieve_of

ROUNDS = 3
MAX_PSEUDO = 5_000
CONFIDENT = 0.97
BINS = 12
BUCKETS = 256  # of hashed languages and sources
HELD_OUT = 4  # every fourth labelled document calibrates
KEEP_FROM = 0.5

TEXT = [
    "words",
    "word_length",
    "symbols",
    "dup_lines",
    "repeats",
    "distinct",
    "doubled",
    "digits",
    "flagged",
    "flagged_words",
]
META = ["length", "lang", "origin"]
READ = ["text", "n_chars", "lang", "source"]  # as far as documents have them
KEYS = fields(("key_1", "long"), ("key_2", "long"))
FEATURES = fields(
    ("doc_id", "long"), ("key_1", "long"), ("key_2", "long"), *[(c, "double") for c in TEXT + META]
)


def text_features(text: bytes, lexicon: frozenset[bytes]) -> list[float]:
    words, chars, symbols, dup, repeat, lines, distinct, doubled, digits, flagged = counts(
        text, lexicon
    )
    n = max(words, 1)
    return [
        np.log1p(words),
        chars / n,
        symbols / n,
        dup / max(lines, 1),
        repeat / n,
        distinct / n,
        doubled / n,
        digits / n,
        flagged / n,
        float(flagged),
    ]


def _bucket(value: str | None) -> float:
    return 0.0 if value is None else 1.0 + xxhash.xxh64_intdigest(str(value)) % (BUCKETS - 1)


def _features(b: pa.RecordBatch, lexicon: frozenset[bytes]) -> list[list[float]]:
    def values(name: str) -> list:
        return b.column(name).to_pylist() if name in b.schema.names else [None] * b.num_rows

    rows = []
    for text, size, lang, source in zip(
        texts(b.column("text")), values("n_chars"), values("lang"), values("source"), strict=True
    ):
        meta = [np.log1p(max(size or 0, 0)), _bucket(lang), _bucket(source)]
        rows.append(text_features(text, lexicon) + meta)
    return rows


# ---------------------------------------------------------------- models
@dataclass
class View:
    """Logistic regression over one-hot bins of a few features."""

    columns: list[int]
    edges: list[np.ndarray]
    weights: np.ndarray

    @staticmethod
    def binned(x: np.ndarray, columns, edges) -> np.ndarray:
        """Positions of the ones in every row; position 0 is the intercept."""
        out, at = [np.zeros(len(x), np.int64)], 1
        for c, e in zip(columns, edges, strict=True):
            out.append(at + np.searchsorted(e, x[:, c], side="left"))
            at += len(e) + 1
        return np.column_stack(out)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, columns: list[int], categories: set[int]) -> View:
        edges = []
        for c in columns:
            if c in categories:
                edges.append(np.arange(BUCKETS) + 0.5)
            else:
                e = np.unique(np.quantile(x[:, c], np.linspace(0, 1, BINS + 1)[1:-1]))
                edges.append(np.unique(np.append(e, [0.0, 0.5])))
        ones = cls.binned(x, columns, edges)
        size = 1 + sum(len(e) + 1 for e in edges)
        w = np.zeros(size)
        for _ in range(12):  # Newton steps with an L2 penalty
            p = 1 / (1 + np.exp(-np.clip(w[ones].sum(1), -30, 30)))
            gradient = np.bincount(
                ones.ravel(), np.repeat(p - y, ones.shape[1]), minlength=size
            ) + np.where(np.arange(size) == 0, 0, w)
            curve, h = np.zeros((size, size)), p * (1 - p)
            for i in range(ones.shape[1]):
                for j in range(ones.shape[1]):
                    np.add.at(curve, (ones[:, i], ones[:, j]), h)
            curve[np.diag_indices(size)] += 1.0
            step = np.linalg.solve(curve, gradient)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return cls(columns, edges, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.binned(x, self.columns, self.edges)].sum(1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def platt(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (one per column of ``z``, and an intercept) that turn logits into probabilities."""
    z = np.column_stack([z, np.ones(len(z))])
    w = np.zeros(z.shape[1])
    for _ in range(25):
        p = _sigmoid(z @ w)
        gradient = z.T @ (p - y) + 1e-2 * w
        curve = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(curve, gradient)
    return w


@dataclass
class Model:
    """Both views, their calibrations, and the calibrated combination; None scores 0.5."""

    text: View
    meta: View
    own: list[np.ndarray]
    both: np.ndarray

    def views(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of a good document, a column per view."""
        z = [v.logit(x) for v in (self.text, self.meta)]
        return np.column_stack(
            [_sigmoid(a * w[0] + w[1]) for a, w in zip(z, self.own, strict=True)]
        )

    def score(self, x: np.ndarray) -> np.ndarray:
        p = np.clip(self.views(x), 1e-6, 1 - 1e-6)
        return _sigmoid(np.log(p / (1 - p)) @ self.both[:-1] + self.both[-1])


_TEXT = list(range(len(TEXT)))
_META = list(range(len(TEXT), len(TEXT) + len(META)))
_CATEGORIES = {len(TEXT) + META.index(c) for c in ("lang", "origin")}


def fit_model(x, y, pseudo, x_held, y_held) -> Model:
    """``pseudo``: per view the rows and labels the other view gave it."""
    views = []
    for columns, (more_x, more_y) in zip((_TEXT, _META), pseudo, strict=True):
        views.append(
            View.fit(np.vstack([x, more_x]), np.append(y, more_y), columns, _CATEGORIES)
        )
    own = [platt(v.logit(x_held)[:, None], y_held) for v in views]
    model = Model(*views, own, np.zeros(3))
    p = np.clip(model.views(x_held), 1e-6, 1 - 1e-6)
    model.both = platt(np.log(p / (1 - p)), y_held)
    return model


def _confident(
    features: DataFrame, model: Model, view: int, labelled: np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """Unlabelled rows that one view is certain of, for the other one: at most ``most``, by hash of
    the id, out of all documents."""
    names = TEXT + META
    out = fields(("doc_id", "long"), ("good", "int"), *[(c, "double") for c in names])
    schema = arrow_schema(out)

    def choose(batches):
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy() for c in names])
            if not len(x):
                continue
            p = model.views(x)[:, view]
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            sure = (p >= CONFIDENT) | (p <= 1 - CONFIDENT)
            sure &= ~np.isin(ids, labelled)
            chosen = b.filter(pa.array(sure))
            good = (p[sure] >= 0.5).astype(np.int32)
            yield batch(schema, [chosen.column("doc_id"), good,
                                 *[chosen.column(c) for c in names]])

    rows = (
        features.filter(F.col("doc_id").isNotNull())
        .mapInArrow(choose, out)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
        .toPandas()
    )
    return rows[names].to_numpy(float).reshape(-1, len(names)), rows["good"].to_numpy(float)


def _keys(docs: DataFrame) -> list[Column]:
    """128 bits of all that the features of a row are made of."""
    read = [F.col(c).cast("string") for c in READ if c in docs.columns]
    parts = [part for c in read for part in (c, c.isNull())]
    return [F.xxhash64(F.lit(name), *parts).alias(name) for name in KEYS.names]


def document_features(docs: DataFrame, lexicon: frozenset[bytes]) -> DataFrame:
    schema = arrow_schema(FEATURES)

    def measure(batches):
        for b in batches:
            columns = list(zip(*_features(b, lexicon), strict=True)) or [()] * len(TEXT + META)
            own = [b.column(c) for c in ("doc_id", *KEYS.names)]
            yield batch(schema, [*own, *columns])

    read = [c for c in READ if c in docs.columns]
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *read, *_keys(docs))
    return chosen.mapInArrow(measure, FEATURES)


@dataclass
class Trained:
    model: Model | None
    lexicon: frozenset[bytes]
    features: DataFrame  # of all documents, stored


def train(
    docs: DataFrame,
    labels: DataFrame,
    rounds: int = ROUNDS,
    most: int = MAX_LABELLED,
    most_pseudo: int = MAX_PSEUDO,
) -> Trained:
    spark = docs.sparkSession
    sample = {r.doc_id: r.bad for r in labelled_ids(docs, labels, most).collect()}
    fitted = {i: bad for i, bad in sample.items() if xxhash.xxh64_intdigest(str(i)) % HELD_OUT}
    lexicon = learn_lexicon(docs, fitted)
    features = staging(spark)(document_features(docs, lexicon), "features")
    names = TEXT + META
    known = spark.createDataFrame(list(sample.items()), "doc_id long, bad int")
    rows: pd.DataFrame = (
        features.join(F.broadcast(known), "doc_id")  # at most MAX_LABELLED rows
        .groupBy("doc_id")
        .agg(F.min(F.struct("bad", *names)).alias("row"))
        .select("doc_id", "row.*")
        .toPandas()
        .sort_values("doc_id")
    )
    held = ~rows["doc_id"].isin(list(fitted)).to_numpy(bool)
    x, y = rows[names].to_numpy(float), 1.0 - rows["bad"].to_numpy(float)
    if len({*y[held]}) < 2 or len({*y[~held]}) < 2:
        return Trained(None, lexicon, features)
    nothing = (np.empty((0, len(names))), np.empty(0))
    given = [nothing, nothing]
    labelled = np.array(sorted(sample), np.int64)
    for _ in range(rounds):
        model = fit_model(x[~held], y[~held], given, x[held], y[held])
        taught = [
            _confident(features, model, view, labelled, most_pseudo) for view in (0, 1)
        ]
        given = [taught[1], taught[0]]  # each view learns from the other
    model = fit_model(x[~held], y[~held], given, x[held], y[held])
    return Trained(model, lexicon, features)


SCORES = fields(
    ("doc_id", "long"), ("text_score", "double"), ("metadata_score", "double"), ("score", "double"),
    ("kept", "boolean"),
)


def score_documents(trained: Trained) -> DataFrame:
    """Scores and verdict of every document."""
    model, names, schema = trained.model, TEXT + META, arrow_schema(SCORES)

    def score(batches):
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy() for c in names])
            if model is None or not len(x):
                p, s = np.full((len(x), 2), 0.5), np.full(len(x), 0.5)
            else:
                p, s = model.views(x), model.score(x)
            yield batch(schema, [b.column("doc_id"), p[:, 0], p[:, 1], s, s >= KEEP_FROM])

    return trained.features.mapInArrow(score, SCORES)


def keep_good(docs: DataFrame, trained: Trained) -> DataFrame:
    """The documents whose score reaches ``KEEP_FROM``, with all their columns.

    Texts are not measured again: the stored features name what is rejected, by a hash of all the
    features come from. A Bloom filter of these keys lets most other documents pass without a
    shuffle; those it holds back meet the keys themselves. ``docs`` is read twice and should be a
    stored table, the one ``trained`` comes from.
    """
    model, names, schema = trained.model, TEXT + META, arrow_schema(KEYS)
    if model is None:
        return docs

    def reject(batches):
        for b in batches:
            if b.num_rows:
                x = np.column_stack([b.column(c).to_numpy() for c in names])
                b = b.filter(pa.array(~(model.score(x) >= KEEP_FROM)))
            yield batch(schema, [b.column(c) for c in KEYS.names])

    store = staging(docs.sparkSession)
    rejected = store(trained.features.mapInArrow(reject, KEYS).distinct(), "rejected")
    sieve = sieve_of(rejected, store)
    rows = docs.select(F.struct("*").alias("row"), *_keys(docs))  # no name of docs can clash
    if sieve is None:
        kept = rows.join(rejected, KEYS.names, "left_anti")
    else:
        held = sieve.maybe(rows, KEYS.names)
        kept = sieve.surely_not(rows, KEYS.names).unionAll(
            held.join(rejected, KEYS.names, "left_anti").select(rows.columns)
        )
    return kept.select("row.*")
