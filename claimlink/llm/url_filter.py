"""URL filter lists: allow and block rules on host suffixes and path prefixes.

A URL is expanded into its (host suffix, path prefix) expressions, as many as the rules have
different label counts and path lengths. Expressions and rules meet in an equi-join on the first
four bytes of their SHA-256; the full digest confirms, and precedence picks among the rules that
fit. Expansion and join work on distinct (host, path), so a URL or page repeated a million times
costs one row; the verdict returns by a join that splits hot keys at run time.

Defined results: a null URL, or one without ``://``, has empty host and path. Rules fit their host
and its subdomains. The longest rule (host and path together) wins, then the longer host, then
``block``. A rule with an empty host fits every host. Rules with null fields are left out. No fit:
rule null, verdict ``allow``. Repeated rows are judged alike and all returned; extra columns are
not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_CHARACTERS = 8  # of the hexadecimal digest: four bytes
DEFAULT_VERDICT = "allow"
_URL = r"://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def _labels(host: Column) -> Column:
    dots = F.length(host) - F.length(F.translate(host, ".", ""))
    return F.when(host == "", F.lit(0)).otherwise(dots + 1)


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row; ``rules`` has host, path and verdict."""
    rules = rules.select("host", "path", "verdict").dropna()
    shapes = rules.select(
        _labels(F.col("host")).alias("labels"), F.length("path").alias("length")
    ).distinct()
    # As many rows as the rules have label counts and path lengths.
    shapes = sorted((r.labels, r.length) for r in shapes.collect())

    urls = pages.select(
        F.col(id_column),
        host_of(F.col(url_column)).alias("host"),
        path_of(F.col(url_column)).alias("path"),
    )
    host, path = F.col("host"), F.col("path")
    expressions = [
        F.when(
            (_labels(host) >= labels) & (F.length(path) >= length),
            _digest(
                F.substring_index(host, ".", -labels) if labels else F.lit(""),
                F.substring(path, 1, length) if length else F.lit(""),
            ),
        )
        for labels, length in shapes
    ]
    expanded = urls.select("host", "path").distinct().select(
        "host",
        "path",
        F.explode(
            F.array_compact(F.array(*expressions, F.lit(None).cast("string")))
        ).alias("digest"),
    )
    listed = rules.select(
        _digest(host, path).alias("rule_digest"),
        F.concat(host, path).alias("rule"),
        F.length(host).alias("host_length"),
        "verdict",
    )
    fits = (
        expanded.withColumn("short", F.substring("digest", 1, PREFIX_CHARACTERS))
        .join(
            listed.withColumn("short", F.substring("rule_digest", 1, PREFIX_CHARACTERS)),
            "short",
        )
        .filter(F.col("digest") == F.col("rule_digest"))
    )
    best = fits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule"), "host_length", "verdict", "rule")).alias("best")
    )
    return urls.join(best, ["host", "path"], "left").select(
        id_column,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
    )
