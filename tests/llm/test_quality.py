"""Quality rules and co-training: exact statistics, held-out accuracy, odd inputs."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from llm_helpers import DATA, pairs, same

from claimlink.llm import cotraining, quality_rules, text_stats
from claimlink.llm.quality_rules import Condition

LABELS = "doc_id long, quality int, toxic int"


def base(text):
    """The contract's statistics, written plainly."""
    text = text or ""
    blank = " \t\n\x0b\x0c\r"

    def split(t):
        return [w for w in "".join(" " if c in blank else c for c in t).split(" ") if w]

    words = split(text)
    lines = [x for x in text.split("\n") if split(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


@pytest.fixture(scope="module")
def labels(session):
    return session.read.parquet(f"{DATA}/labels.parquet")


def contract(judged):
    return judged.select("doc_id", *text_stats.COUNTS, "base_failed")


def stated(docs):
    for i, t in docs:
        s = base(t)
        yield (i, *s, s[0] < 10 or 100 * s[4] > 20 * s[0])


def test_statistics(odd_documents, sample_documents, labels):
    for docs in (odd_documents, sample_documents):
        judged, _ = quality_rules.judge_documents(docs, labels)
        same(contract(judged), stated(pairs(docs)))
        assert judged.filter("base_failed AND kept").count() == 0


def test_rules_cover_bad_rows_only():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    bad = ((x[:, 0] > 0.8) & (x[:, 1] < 0.5)) | (x[:, 2] > 0.95)
    rules = quality_rules.learn_rules(["a", "b", "c"], x, bad)
    assert 2 <= len(rules) <= quality_rules.MAX_RULES
    new = rng.random((3000, 3))
    said = np.zeros(len(new), bool)
    for rule in rules:
        fits = np.ones(len(new), bool)
        for c in rule:
            fits &= (new[:, "abc".index(c.feature)] > c.threshold) == c.above
        said |= fits
    truth = ((new[:, 0] > 0.8) & (new[:, 1] < 0.5)) | (new[:, 2] > 0.95)
    assert (said == truth).mean() > 0.97


def test_rules_are_one_ordered_conditional(session):
    from pyspark.sql import functions as F

    rules = [(Condition("a", True, 5.0), Condition("b", False, 1.0)), (Condition("a", True, 3.0),)]
    df = session.createDataFrame([(6, 0), (6, 2), (4, 9), (1, 1)], "a int, b int")
    said = quality_rules.rejecting_rule(rules, {"a": F.col("a"), "b": F.col("b")})
    assert [r[0] for r in df.select(said).collect()] == [
        "a > 5 and b <= 1", "a > 3", "a > 3", None
    ]
    assert session.range(1).select(quality_rules.rejecting_rule([], {})).first()[0] is None


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_held_out_accuracy(session, folder):
    """Half of the labels fit, the other half judge."""
    docs = session.read.parquet(f"{folder}/documents.parquet")
    labels = session.read.parquet(f"{folder}/labels.parquet")
    half = labels.filter("xxhash64(doc_id, 'half') % 2 = 0")
    rest = labels.subtract(half).selectExpr("doc_id", "quality = 1 AND toxic = 0 AS good")
    judged, rules = quality_rules.judge_documents(docs, half)
    scored = cotraining.score_documents(cotraining.train(docs, half))
    for result, least in ((judged, 0.93), (scored, 0.95)):
        rows = result.join(rest, "doc_id").select("kept", "good").collect()
        assert len(rows) > 500
        assert np.mean([r.kept == r.good for r in rows]) > least
        assert np.mean([r.kept for r in rows if r.good]) > 0.93
    assert rules


def test_two_views_and_their_combination(sample_documents, labels):
    trained = cotraining.train(sample_documents, labels)
    scores = cotraining.score_documents(trained)
    assert scores.count() == sample_documents.count()
    assert scores.filter("NOT (score BETWEEN 0 AND 1)").count() == 0
    kept = cotraining.keep_good(sample_documents, trained)
    assert kept.schema == sample_documents.schema
    same(kept.select("doc_id"), scores.filter("kept").select("doc_id").collect())


def test_verdicts_meet_the_texts_without_measuring_again(
    session, sample_documents, labels, monkeypatch
):
    """With and without a filter, among names a helper column might have, with repeated rows."""
    from pyspark.sql import functions as F

    docs = sample_documents.unionAll(sample_documents.limit(40)).select(
        "*",
        *[F.lit(n).alias(c) for n, c in enumerate(
            ["row", "key_1", "KEY_2", "_sieve_block", "_sieve_0", "kept", "words", "a.b"]
        )],
    )
    trained = cotraining.train(docs, labels)
    bad = {r.doc_id for r in cotraining.score_documents(trained).filter("NOT kept").collect()}
    want = sorted(r.doc_id for r in docs.select("doc_id").collect() if r.doc_id not in bad)
    assert 0 < len(want) < docs.count()

    def never(*_):
        raise AssertionError("texts are measured again")

    monkeypatch.setattr(cotraining, "_features", never)
    for _ in range(2):
        kept = cotraining.keep_good(docs, trained)
        assert kept.schema == docs.schema
        assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == want
        monkeypatch.setattr(cotraining, "sieve_of", lambda *_: None)


def test_a_labelled_id_with_two_texts(session, sample_documents, labels):
    """The fit does not depend on the order of rows."""
    some = sample_documents.limit(60)
    other = some.withColumn("text", some["lang"])
    docs = sample_documents.unionAll(other)
    models = []
    for parts in (2, 7):
        trained = cotraining.train(docs.repartition(parts), labels)
        found = cotraining.score_documents(trained).select("doc_id", "score").collect()
        models.append(sorted((r.doc_id, round(r.score, 9)) for r in found))
    assert models[0] == models[1]


def test_pseudo_labels_teach_the_other_view():
    """A view that labels cannot train learns from the other one's certain rows."""
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400).astype(float)
    x = np.zeros((400, 13))
    x[:, 8] = 1 - y + rng.normal(0, 0.02, 400)
    more = x.copy()
    more[:, 10] = y * 3  # only unlabelled rows show the metadata signal
    nothing = (np.empty((0, 13)), np.empty(0))
    alone = cotraining.fit_model(x[:300], y[:300], [nothing, nothing], x[300:], y[300:])
    taught = cotraining.fit_model(x[:300], y[:300], [nothing, (more, y)], x[300:], y[300:])

    def spread(m):
        return np.abs(m.meta.logit(more[y == 1]) - m.meta.logit(more[y == 0][:1])).mean()

    assert spread(alone) < 0.1 < 1 < spread(taught)


def test_odd_inputs(session, odd_documents, no_documents, labels):
    none = labels.limit(0)
    one_class = session.createDataFrame([(0, 1, 0), (7, 1, 0)], LABELS)
    odd = session.createDataFrame(
        [(None, 1, 0), (0, None, 0), (7, 0, None), (7, 1, 0), (14, 1, 1), (999, 0, 0)], LABELS
    )
    for docs in (odd_documents, no_documents):
        n = docs.count()
        for some in (none, one_class, odd, labels):
            judged, _ = quality_rules.judge_documents(docs, some)
            assert judged.count() == n
            trained = cotraining.train(docs, some)
            assert cotraining.score_documents(trained).count() == n
            assert cotraining.keep_good(docs, trained).count() <= n
    assert cotraining.score_documents(cotraining.train(odd_documents, none)).filter(
        "score = 0.5 AND kept").count() == odd_documents.count()
    known = {r.doc_id: r.bad for r in text_stats.labelled_ids(odd_documents, odd).collect()}
    assert known == {7: 1, 14: 1}


def test_toxic_labels_without_a_quality_count_as_bad(session, odd_documents):
    odd = session.createDataFrame(
        [(0, None, 1), (7, None, 0), (14, None, None), (21, 1, None), (28, None, 1), (28, 1, 0)],
        LABELS,
    )
    known = {r.doc_id: r.bad for r in text_stats.labelled_ids(odd_documents, odd).collect()}
    assert known == {0: 1, 21: 0, 28: 1}


def test_lexicon(session):
    good = [(i, f"plain words only nr{i} here") for i in range(30)]
    bad = [(100 + i, f"plain nasty{i}, words Awful! here") for i in range(30)]
    docs = session.createDataFrame(good + bad, "doc_id long, text string")
    lexicon = text_stats.learn_lexicon(docs, {i: int(i >= 100) for i, _ in good + bad})
    assert {b"awful", b"nast*"} <= lexicon and not {b"plain", b"words", b"here"} & lexicon
    assert text_stats.count_flagged(Counter(b"so awful, nastyness plain".split()), lexicon) == 2
