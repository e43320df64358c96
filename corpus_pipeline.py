"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps, with the columns of
``documents`` (the last one: packed pieces). ``run`` writes every stage as Parquet into the shared
folder and rereads it, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlink.llm import cotraining, decontaminate, packing, secret_scan, simhash
from claimlink.llm.common import prepare, staging, steps_in, table
from claimlink.sources import Staging


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    prepare(spark)
    return cotraining.keep_good(docs, cotraining.train(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare(spark)
    return simhash.keep_one_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    prepare(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    prepare(spark)
    return secret_scan.mask_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in a sequence."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

# Learned scores, connected components and token ids are not SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, store: Staging | None = None) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    Their stored steps go into ``store``, whose ``drop()`` removes them when the result is saved.
    """
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    with steps_in(store or staging(spark)) as steps:
        for name, stage in STAGES:
            docs = steps(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
