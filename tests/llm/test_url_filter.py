"""URL rules against string comparison, rule by rule."""

from __future__ import annotations

import random
import re

import pytest
from llm_helpers import same

from claimlink.llm import url_filter
from claimlink.llm.queries import URL_RULES

RULES = "host string, path string, verdict string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(pages, rules):
    for i, url in pages:
        m = re.search("://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
        fits = [
            (len(h + p), len(h), v, h + p)
            for h, p, v in rules
            if None not in (h, p, v)
            and (h in ("", host) or host.endswith("." + h))
            and path.startswith(p)
        ]
        _, _, verdict, rule = max(fits, default=(0, 0, "allow", None))
        yield i, host, path, rule, verdict


ODD = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://EXAMPLE.org/es/x"),
    (6, "http://notexample.org/es/"), (7, "http://a.b.Example.ORG/en/12?q#f"),
    (8, "http://example.org"), (9, "http://example.org?/es/"), (10, "http://example.org#/es/"),
    (11, "x://y.com/fr/://z.org/"), (12, "http://com/de/"), (13, "http://.com/fr/"),
    (14, "http://É.org/ÉÉ"), (None, "http://a.org/"), (5, "http://EXAMPLE.org/es/x"),
    (15, "http://" + "a." * 500 + "org/" + "x" * 5000), (16, "http://a.org./"),
]


@pytest.fixture(scope="module")
def pages(session):
    rng = random.Random(3)
    rows = ODD + [
        (100 + k, "http://" + ".".join(rng.choices(["a", "b", "org", "com", "example"], k=3))
         + "/" + "/".join(rng.choices(["es", "en", "1", "fr", "de"], k=rng.randrange(4))) + "/")
        for k in range(300)
    ]
    df = session.createDataFrame(rows, "page_id long, url string")
    return rows, df.selectExpr("*", "'x' AS host", "'y' AS rule", "1 AS best").repartition(3)


@pytest.mark.parametrize(
    "rules",
    [
        URL_RULES,
        [("", "", "block"), ("org", "/", "allow"), ("b.org", "", "block"), ("org", "/e", "block"),
         ("org", "/", "block"), ("com", "//", "allow"), (None, "/", "allow"), ("a", None, "block")],
        [],
    ],
)
def test_rules(session, pages, rules):
    rows, df = pages
    listed = session.createDataFrame(rules, RULES)
    same(url_filter.judge_urls(df, listed), expected(rows, rules))


def test_colliding_prefixes_are_confirmed(session, pages, monkeypatch):
    monkeypatch.setattr(url_filter, "PREFIX_CHARACTERS", 1)
    rows, df = pages
    listed = session.createDataFrame(URL_RULES, RULES)
    same(url_filter.judge_urls(df, listed), expected(rows, URL_RULES))


def test_no_pages(session, pages):
    listed = session.createDataFrame(URL_RULES, RULES)
    assert url_filter.judge_urls(pages[1].limit(0), listed).collect() == []
