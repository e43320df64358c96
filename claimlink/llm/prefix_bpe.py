"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

Merging pairs in rank order gives exactly one sequence of tokens whose neighbours all could stand side
by side: none of the merges that would cross their border comes first. So every prefix of a word has
one last token: of the vocabulary's tokens that are a suffix of the prefix (an automaton over all
tokens finds them while it reads the word), it is the one compatible with the last token of what lies
before. These are stored for all prefixes, and back-pointers from the end of the word give its ids.
The work is linear in a word's length, whatever its length.

Words are what the vocabulary's own file says: the strings of added tokens are cut out of the raw text
first, the rest is normalised and split by its pattern. Words come back often, so their ids are looked up.

Defined results: a null text is empty; an empty text, or one of blanks, has no ids and decodes to an
empty text. Repeated rows and rows without an id are encoded each. Extra columns are not read. A very
long text is split in segments; a very long word takes memory in proportion to its length. An empty
table gives no rows.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlink.llm.common import arrow_schema

CACHED_WORDS = 700_000
CACHED_LENGTH = 200
CACHED_PAIRS = 2_000_000
SEGMENT = 1_000_000
END = 256  # of a word: added to its last byte's symbol

ENCODED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("decoded", T.StringType()),
    ]
)


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones for themselves,
    the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Merges:
    """A vocabulary's merges: which tokens may stand side by side, and which tokens exist at all.

    ``symbols`` has each token as a string of symbols, one for each byte and another one for each
    byte that ends a word.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        self.symbols: dict[int, str] = {}
        for character, byte in byte_characters().items():
            for name, symbol in ((character, byte), (character + suffix, byte + END)):
                if name not in vocabulary:
                    raise ValueError(f"no token for the single byte {name}")
                self.symbols[vocabulary[name]] = chr(symbol)
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocabulary[left], vocabulary[right]
            token = vocabulary[left + right]
            if token in self.symbols or not all(p in self.symbols for p in pair):
                raise ValueError(f"a merge out of order, or made twice: {left} {right}")
            self.rank[pair] = rank
            self.made[token] = *pair, rank
            self.symbols[token] = self.symbols[pair[0]] + self.symbols[pair[1]]
        self._edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self._pairs: dict[int, bool] = {}
        self.reachable = self._reachable()

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """(part, rank of the merge that takes it up) of the parts at a token's left (0) or right
        (1) edge, the token itself first."""
        found = self._edges.get((token, side))
        if found is None:
            found, taken, part = [], float("inf"), token
            while True:
                found.append((part, taken))
                if part not in self.made:
                    break
                taken, part = self.made[part][2], self.made[part][side]
            self._edges[token, side] = found
        return found

    def _crossing(self, left: int, right: int) -> Iterator[int]:
        """Ranks of merges across the border that come before both parts are taken up. Of equal
        merges the one further left comes first."""
        for a, a_taken in self.edge(left, 1):
            for b, b_taken in self.edge(right, 0):
                rank = self.rank.get((a, b))
                if rank is not None and rank < a_taken and rank <= b_taken:
                    yield rank

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two stay apart: no merge crosses the border between them."""
        pair = left << 32 | right
        found = self._pairs.get(pair)
        if found is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            found = self._pairs[pair] = next(self._crossing(left, right), None) is None
        return found

    def _reachable(self) -> set[int]:
        """Tokens that their own bytes are merged to: a merge across the border of their two parts
        may not come before their own."""
        there = set(self.symbols) - set(self.made)
        for token, (left, right, rank) in self.made.items():
            if left in there and right in there and min(self._crossing(left, right)) == rank:
                there.add(token)
        return there


class PrefixEncoder:
    """Ids of texts, and texts of ids, for a file of a byte-level vocabulary with merges."""

    def __init__(self, path: str):
        import ahocorasick

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, pattern = said["model"], self._pattern(said)
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.names = {i: name for name, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.names |= {i: content for content, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first)) or "(?!)")
        self.tokens = ahocorasick.Automaton()
        for token in self.merges.reachable:
            symbols = self.merges.symbols[token]
            self.tokens.add_word(symbols, (token, len(symbols)))
        self.tokens.make_automaton()
        self.lengths = {t: len(s) for t, s in self.merges.symbols.items()}
        self.normalise = Tokenizer.from_file(path).normalizer.normalize_str
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.pattern = regex.compile(pattern)
        # For the others normalising is lower-casing alone, and all sides agree what a blank is.
        self.unusual = regex.compile("[^\0-\x1b -ɏ‐-‧‰-⁞]")
        self.blank = regex.compile(r"(?<=[^\s])[ \n]")
        self.cache: dict[str, bytes] = {}

    @staticmethod
    def _pattern(said: dict) -> str:
        """The splitting pattern, if the file is of the kind that is known here."""
        normal = [n["type"] for n in (said["normalizer"] or {}).get("normalizers", [])]
        parts = (said["pre_tokenizer"] or {}).get("pretokenizers", [])
        plain = all(
            not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])
            for t in said["added_tokens"]
        )
        model = said["model"]
        if (
            normal != ["NFC", "Replace", "Lowercase"]
            or [p["type"] for p in parts] != ["Split", "ByteLevel"]
            or (parts[0]["behavior"], parts[0]["invert"]) != ("Removed", True)
            or parts[1]["use_regex"]
            or parts[1]["add_prefix_space"]
            or not plain
            or said["decoder"] is not None
            or model["dropout"]
            or model["unk_token"]
            or model["continuing_subword_prefix"]
            or not model["end_of_word_suffix"]
        ):
            raise ValueError("not a vocabulary of lower-cased words with word ends")
        return parts[0]["pattern"]["Regex"]

    def encode(self, text: str) -> np.ndarray:
        found, at = [], 0
        for special in self.cut.finditer(text):
            found += self._plain(text[at : special.start()])
            found.append(np.int32(self.added[special[0]]).tobytes())
            at = special.end()
        found += self._plain(text[at:] if at else text)
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Without a decoder in the file, the tokens' names stand between blanks."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))

    def _plain(self, text: str) -> list[bytes]:
        return [ids for s in self._segments(text) for ids in self._segment(s)]

    def _segments(self, text: str) -> Iterator[str]:
        """Parts of bounded size, cut in front of a blank: no word and no composition spans that."""
        at = 0
        while len(text) - at > SEGMENT:
            cut = self.blank.search(text, at + SEGMENT)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _segment(self, text: str) -> list[bytes]:
        if self.unusual.search(text):
            return [self._ids(word) for word, _ in self.split(self.normalise(text))]
        runs = text.lower().split()  # no word spans a blank, so whole runs are looked up
        found = list(map(self.cache.get, runs))
        if None in found:
            found = [ids or self._run(run) for run, ids in zip(runs, found, strict=True)]
        return found

    def _run(self, run: str) -> bytes:
        words = self.pattern.findall(run)
        if len(words) == 1:
            return self._ids(words[0])
        return self._keep(run, b"".join(map(self._ids, words)))

    def _ids(self, word: str) -> bytes:
        return self.cache.get(word) or self._keep(
            word, np.array(self.last_tokens(word)[::-1], np.int32).tobytes()
        )

    def _keep(self, word: str, ids: bytes) -> bytes:
        if len(word) <= CACHED_LENGTH:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def last_tokens(self, word: str) -> array:
        """A word's tokens from its last to its first."""
        symbols = word.encode().decode("latin-1")
        symbols = symbols[:-1] + chr(ord(symbols[-1]) + END)
        compatible = self.merges.compatible
        last = array("i", [-1]) * (len(symbols) + 1)  # of every prefix, by its length
        for end, (token, length) in self.tokens.iter(symbols):
            end += 1
            if last[end] < 0 and (end == length or compatible(last[end - length], token)):
                last[end] = token
        found, at = array("i"), len(symbols)
        while at:
            found.append(last[at])
            at -= self.lengths[last[at]]
        return found


@cache
def encoder(path: str) -> PrefixEncoder:
    """One per Python worker, which keeps its words from task to task."""
    return PrefixEncoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of all documents: the ids of the whole text, and what they decode to.

    ``path`` is the vocabulary's file, at the same place on every executor.
    """
    schema = arrow_schema(ENCODED)

    def run(batches):
        coder = encoder(path or default_path())
        for b in batches:
            ids = [coder.encode(t or "") for t in b.column("text").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            values = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets), values, type=schema.field("ids").type)
            texts = pa.array(map(coder.decode, ids), pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists, texts], schema=schema)

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string"))
    return chosen.mapInArrow(run, ENCODED)


def digests(encoded: DataFrame) -> DataFrame:
    """Number and digest of the ids, and digest of what they decode to."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
