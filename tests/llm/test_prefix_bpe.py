"""Encoding by dynamic programming against the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
import regex
from llm_helpers import pairs, prose, same
from tokenizers import Tokenizer

from claimlink.llm import prefix_bpe


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(prefix_bpe.default_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def coder():
    return prefix_bpe.encoder(prefix_bpe.default_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(tokenizer, rows):
    result = []
    for i, t in rows:
        ids = ids_of(tokenizer, t or "")
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        result.append((i, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    return result


def test_odd_documents(odd_documents, tokenizer):
    encoded = prefix_bpe.encode_documents(odd_documents)
    same(prefix_bpe.digests(encoded), expected(tokenizer, pairs(odd_documents)))
    for r in encoded.collect():
        assert tokenizer.decode(r.ids, skip_special_tokens=False) == r.decoded


def test_sample(sample_documents, tokenizer):
    result = prefix_bpe.digests(prefix_bpe.encode_documents(sample_documents))
    same(result, expected(tokenizer, pairs(sample_documents)))


def test_no_documents(no_documents):
    result = prefix_bpe.digests(prefix_bpe.encode_documents(no_documents))
    assert result.collect() == []
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def check(coder, tokenizer, text):
    ids = ids_of(tokenizer, text)
    got = coder.encode(text)
    assert got.tolist() == ids, text
    assert coder.decode(got) == tokenizer.decode(ids, skip_special_tokens=False)


def test_every_character(coder, tokenizer):
    """Alone, between letters and behind one; all below U+3000, others in steps."""
    for c in (*range(0x3000), *range(0x3000, 0x110000, 61)):
        if not 0xD800 <= c < 0xE000:
            check(coder, tokenizer, f"A{chr(c)}b {chr(c)} É{chr(c)}")


@pytest.mark.parametrize("letters", ["a", "ab", "the", "aeioust", "abcdefghijklmnopqrstuvwxyz"])
def test_words(coder, tokenizer, letters):
    rng = random.Random(letters)
    for _ in range(1500):
        check(coder, tokenizer, "".join(rng.choices(letters, k=rng.randrange(1, 70))))


def test_marks_and_special_tokens(coder, tokenizer):
    rng = random.Random(9)
    marks = [*"!.-=_*# \n\t'’é中Ж", "é", "ß", "İ", "Σ", "'s", "'LL", "7", "\x1c", "\x85", "\xa0"]
    special = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>"]
    for _ in range(3000):
        check(coder, tokenizer, "".join(rng.choices(marks + special, k=rng.randrange(1, 40))))


def test_segments_and_full_caches(monkeypatch, coder, tokenizer):
    monkeypatch.setattr(prefix_bpe, "SEGMENT", 50)
    monkeypatch.setattr(prefix_bpe, "CACHED_WORDS", 20)
    monkeypatch.setattr(prefix_bpe, "CACHED_PAIRS", 50)
    rng = random.Random(2)
    for text in (prose(rng, 800), "a  b\n\n c\t" * 80, "中文 é́ " * 90, "x" * 700, "é" * 300 + " é"):
        check(coder, tokenizer, text)


def test_long_words(coder, tokenizer):
    rng = random.Random(6)
    for word in ("a" * 30_000, "ab" * 15_000, "!?" * 20_000,
                 "".join(rng.choices("etaoin", k=50_000))):
        check(coder, tokenizer, word)


def test_last_tokens_of_prefixes(coder, tokenizer):
    """Every prefix has one last token: that of the prefix encoded for itself, inside a word."""
    word = "internationalisations"
    symbols = word.encode().decode("latin-1")
    for n in range(1, len(word)):
        prefix = symbols[:n]
        ends = [t for t, s in coder.merges.symbols.items() if prefix.endswith(s)]
        fits = []
        for t in ends:
            before = prefix[: n - len(coder.merges.symbols[t])]
            if not before or coder.merges.compatible(_last(coder, before), t):
                fits.append(t)
        assert fits == [_last(coder, prefix)]


def _last(coder, prefix):
    """By merging in rank order, without an end of the word."""
    parts = [next(t for t, s in coder.merges.symbols.items() if s == c) for c in prefix]
    while True:
        ranks = [(coder.merges.rank[p], k) for k, p in enumerate(zip(parts, parts[1:], strict=False))
                 if p in coder.merges.rank]
        if not ranks:
            return parts[-1]
        rank, k = min(ranks)
        made = next(t for t, m in coder.merges.made.items() if m[2] == rank)
        parts[k : k + 2] = [made]


def test_unreachable_tokens_are_never_found():
    """``abc`` is made of a and bc, but ab comes first: no text is encoded with it."""
    names = list(prefix_bpe.byte_characters())
    vocabulary = {n: i for i, n in enumerate([*names, *[f"{n}</w>" for n in names]])}
    merges = ["a b", "b c", "a bc"]
    for merge in merges:
        vocabulary[merge.replace(" ", "")] = len(vocabulary)
    found = prefix_bpe.Merges(vocabulary, merges, "</w>")
    assert vocabulary["abc"] not in found.reachable
    assert vocabulary["ab"] in found.reachable and vocabulary["bc"] in found.reachable


@pytest.mark.parametrize("part", ["normalizer", "pre_tokenizer", "decoder", "added_tokens"])
def test_other_kinds_of_files_are_refused(tmp_path, part):
    with open(prefix_bpe.default_path(), encoding="utf-8") as file:
        said = json.load(file)
    said[part] = {
        "normalizer": None,
        "pre_tokenizer": None,
        "decoder": {"type": "ByteLevel"},
        "added_tokens": [said["added_tokens"][0] | {"lstrip": True}],
    }[part]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(said))
    with pytest.raises(ValueError):
        prefix_bpe.PrefixEncoder(str(path))


def test_usual_characters_need_no_library(coder):
    assert not coder.unusual.search("Plain text, ‘quotes’ – ÀÉ\n\t\xa0\x85")
    assert all(coder.unusual.search(c) for c in "\x1c\x1fΣ中́")
    assert regex.findall(coder.pattern, "it's 42") == ["it", "'s", "4", "2"]
