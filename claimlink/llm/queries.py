"""The operators as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlink.llm import (
    cotraining,
    decontaminate,
    hard_negatives,
    packing,
    prefix_bpe,
    quality_rules,
    secret_scan,
    simhash,
    substring_dedup,
    suffix_dedup,
    url_filter,
    warc,
    whitening,
)
from claimlink.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


@_query("op1_quality_rules")
def _(spark, folder):
    judged, _ = quality_rules.judge_documents(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )
    return judged


@_query("op2_quality_classifier")
def _(spark, folder):
    trained = cotraining.train(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return cotraining.score_documents(trained)


_CONTAINMENT_SQL = r"""
WITH item AS (
    SELECT item_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w
    FROM (SELECT DISTINCT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS text FROM benchmark
          WHERE item_id IS NOT NULL AND text IS NOT NULL)
), sized AS (
    SELECT item_id, w, least(5, len(w)) AS k FROM item WHERE len(w) > 0
), item_shingle AS (
    SELECT DISTINCT item_id, k,
        unnest(list_transform(range(1, len(w) - k + 2),
            lambda i: array_to_string(w[i:i + k - 1], ' '))) AS shingle
    FROM sized
), total AS (SELECT item_id, count(*) AS n FROM item_shingle GROUP BY item_id
), document AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), document_shingle AS (
    SELECT DISTINCT doc_id, k,
        unnest(list_transform(range(1, len(w) - k + 2),
            lambda i: array_to_string(w[i:i + k - 1], ' '))) AS shingle
    FROM document, (SELECT DISTINCT k FROM sized) AS sizes
    WHERE len(w) >= k
), hit AS (
    SELECT doc_id, item_id, count(*) AS n
    FROM document_shingle JOIN item_shingle USING (k, shingle) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, total.n AS n_shingles, hit.n AS n_contained,
    hit.n::DOUBLE / total.n AS containment
FROM hit JOIN total USING (item_id) WHERE 10 * hit.n >= 8 * total.n
"""


@_query("op3_benchmark_decontamination", _CONTAINMENT_SQL)
def _(spark, folder):
    return decontaminate.contaminated_pairs(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


_WARC_SQL = """
WITH payload AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), original AS (
    SELECT *, CASE WHEN payload_bytes >= 1000
        THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes)
        ELSE page_id END AS response
    FROM payload
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> response THEN response END AS refers_to
FROM original
"""


@_query("op4_warc_revisits", _WARC_SQL)
def _(spark, folder):
    return warc.deduplicate_pages(table(spark, folder, "pages"))


@_query("op5_best_fit_packing")
def _(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


@_query("op6_simhash_near_dedup")
def _(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@_query("op7_suffix_array_dedup")
def _(spark, folder):
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


URL_RULES = [  # fixed values: the rules of the query
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
_URL_SQL = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}
), parts AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
)
SELECT page_id, host, path,
    arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    coalesce(arg_max(rule_verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM parts LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
""".format(rules=", ".join(str(r) for r in URL_RULES))


@_query("op8_url_filter", _URL_SQL)
def _(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, folder, "pages"), rules)


@_query("op9_substring_dedup")
def _(spark, folder):
    return substring_dedup.remove_later_repeats(table(spark, folder, "documents"))


@_query("op10_secret_scan")
def _(spark, folder):
    return secret_scan.find_secrets(table(spark, folder, "documents"))


_HARD_NEGATIVES_SQL = """
WITH taking AS (
    SELECT DISTINCT vec_id,
        CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS INTEGER) AS label,
        list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), anchor AS (SELECT * FROM taking WHERE vec_id % 50 = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
        CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
    FROM anchor AS a, taking AS r WHERE a.vec_id <> r.vec_id
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@_query("op11_hard_negatives", _HARD_NEGATIVES_SQL)
def _(spark, folder):
    embeddings = table(spark, folder, "embeddings")
    label = F.col("label")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    taking = hard_negatives.labelled_vectors(embeddings, moved)
    return hard_negatives.mine(taking, lambda vec_id: vec_id % 50 == 0)


@_query("op12_embedding_whitening")
def _(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


@_query("op13_bpe_encoding")
def _(spark, folder):
    return prefix_bpe.digests(prefix_bpe.encode_documents(table(spark, folder, "documents")))
