"""The pipeline's stages, each against its operator's brute force on its own input, and the
registered queries against their SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from llm_helpers import DATA, pairs
from test_decontaminate import expected as contaminated
from test_simhash import linked

import __spark_entry__ as driver
import corpus_pipeline
from claimlink.llm import cotraining, queries
from claimlink.llm.common import staging, steps_in
from claimlink.sources import Staging

TABLES = ["documents", "pages", "benchmark", "labels", "embeddings"]


def test_stages(session):
    store, given = staging(session), {}
    docs = session.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.dtypes
    for name, stage in corpus_pipeline.STAGES:
        given[name] = docs
        docs = store(stage(session, docs, DATA), name.replace(" ", "_"))
        if name != "best-fit packing":
            assert docs.dtypes == columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    kept = {n: given[m] for n, m in zip(names, names[1:], strict=False)} | {names[-1]: docs}
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    labels = session.read.parquet(f"{DATA}/labels.parquet")
    trained = cotraining.train(given[names[0]], labels)
    scores = cotraining.score_documents(trained)
    assert ids(kept[names[0]]) == ids(scores.filter("kept"))
    groups = linked(pairs(given[names[1]]))
    assert ids(kept[names[1]]) == sorted({c for _, _, c in groups})
    items = [tuple(r) for r in session.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = {w[0] for w in contaminated(pairs(given[names[2]]), items)}
    assert ids(kept[names[2]]) == [i for i in ids(given[names[2]]) if i not in bad]
    assert ids(kept[names[3]]) == ids(given[names[3]])
    before, after = dict(pairs(given[names[3]])), dict(pairs(kept[names[3]]))
    assert all("[" in after[i] for i in after if after[i] != before[i])
    assert set(ids(docs)) == set(ids(given[names[4]]))

    run = corpus_pipeline.run(session, DATA)
    assert run.columns == docs.columns
    assert run.drop("sequence_id", "offset").exceptAll(docs.drop("sequence_id", "offset")).isEmpty()


def test_stages_take_empty_and_odd_documents(session, no_documents, odd_documents):
    for docs in (no_documents, odd_documents.select(no_documents.columns)):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(session, docs, DATA)
            if name != "best-fit packing":
                assert result.dtypes == docs.dtypes
            result.collect()


HELPERS = ["_id", "_print", "_root", "_component", "__id", "id", "print", "root", "component",
           "rows", "bad", "kept", "score", "item_id", "key", "anchor", "row", "shard", "length",
           "piece", "start", "spans", "node", "component_id"]


def test_stages_take_documents_with_clashing_columns(session, odd_documents, no_documents):
    """Every stage keeps the columns, whatever they are called, and the same rows as without."""
    plain = odd_documents.select(no_documents.columns)
    clashing = plain.selectExpr("*", *[f"'x' AS `{c}`" for c in HELPERS])
    for name, stage in corpus_pipeline.STAGES:
        want, got = stage(session, plain, DATA), stage(session, clashing, DATA)
        if name == "best-fit packing":
            assert got.columns == want.columns
            assert got.count() == want.count()
            continue
        assert got.dtypes == clashing.dtypes
        shown = [sorted(map(tuple, df.select(plain.columns).collect()), key=repr)
                 for df in (want, got)]
        assert shown[0] == shown[1]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_its_sql(session, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    result = queries.QUERIES[name](session, DATA)
    order = ", ".join(f'"{c}"' for c in sorted(result.columns))
    relation = con.execute(f"SELECT {order} FROM ({queries.ORACLE[name]})")
    expected = sorted(relation.fetchall(), key=repr)
    got = sorted((tuple(r) for r in result.select(*sorted(result.columns)).collect()), key=repr)
    assert got == expected


def test_steps_of_all_operators_can_be_dropped(session):
    """Given a store, operators keep their steps there and nowhere else."""
    spark = session
    root = Path(staging(spark).folder.removeprefix("file:")).parent
    folders = lambda: {p.name for p in root.iterdir() if p.name.startswith("claimlink-")}
    store, before = Staging(spark), folders()
    with steps_in(store):
        for name in ("op4_warc_revisits", "op6_simhash_near_dedup", "op11_hard_negatives"):
            for _ in range(2):
                queries.QUERIES[name](spark, DATA).collect()
    result = corpus_pipeline.run(spark, DATA, store)
    assert result.count() > 0
    assert folders() - before == {Path(store.folder).name}
    store.drop()
    assert folders() == before
    corpus_pipeline.run(spark, DATA).count()
    assert len(folders()) == len(before) + 1


def test_all_are_registered():
    names = set(driver.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(driver.oracle_sql()) <= names


def test_nothing_else_imports_the_subpackage(repository):
    for path in (repository / "claimlink").rglob("*.py"):
        if "llm" not in path.parts:
            assert "claimlink.llm" not in path.read_text()
