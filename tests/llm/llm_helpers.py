"""Shared by the tests of this folder."""

from __future__ import annotations

import random

DATA = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, size: int = 400) -> str:
    """Words of an invented language; few enough that short grams repeat by chance."""
    return " ".join(rng.choice("aeiou") + str(rng.randrange(size)) for _ in range(n))


def pairs(df) -> list[tuple]:
    """(doc_id, text) of all rows."""
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(result, expected) -> None:
    """Equal as multisets of rows."""
    got = sorted((tuple(r) for r in result.collect()), key=repr)
    assert got == sorted(map(tuple, expected), key=repr)
