"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Documents become token ids (a public tokenizer's file, one end id behind each document); those
longer than a sequence are cut into whole sequences, the remainder first. Pieces are stored with a
row number and dealt by its hash into shards of about ``SHARD_PIECES``, so a shard is bounded
whatever the corpus, and hot sources, copies, repeated rows and null ids spread evenly. A shard is packed by best fit from the longest piece down and
then improved by a local search: from the emptiest sequence up, pieces leave for other underfull
sequences by a move, by exchange for one smaller piece, or for two smaller pieces. Every exchange
raises the sum of squared fills, so the search ends; a sequence that runs empty is gone.

Defined results: a null text is empty, so it is one piece holding the end id alone. Repeated rows
are packed each. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import os
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlink.llm.common import arrow_schema, batch, fields, staging

CAPACITY = 1024
END_ID = 2
SHARD_PIECES = 40_000
CACHED_WORDS = 1_000_000
SEGMENT = 1_000_000

PIECES = fields(
    ("doc_id", "long"),
    ("piece", "int"),
    ("start", "long"),
    ("length", "long"),
    ("ids_crc32", "long"),
)


def _usual_parts() -> re.Pattern:
    """How a byte-level vocabulary parts a text of the usual characters: contractions, then
    letters, digits or other marks with a blank in front, then blanks."""
    usual = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250))]
    letters = "".join(c for c in usual if unicodedata.category(c)[0] == "L")
    digits = "".join(c for c in usual if unicodedata.category(c)[0] == "N")
    blank = "\t\n\r "
    kinds = [f"[{letters}]", f"[{digits}]", f"[^{letters}{digits}{blank}]"]
    return re.compile(
        "'(?:s|t|re|ve|m|ll|d)|"
        + "|".join(f" ?{k}+" for k in kinds)
        + f"|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    Byte-level vocabularies first part a text by a fixed pattern and merge inside the parts only, so
    the ids of a part are looked up, and encoded once per part. Texts with characters for which
    Unicode versions or blanks could part differently, or with the string of an added token, which
    is one id, go to the tokenizer whole.
    """

    def __init__(
        self,
        path: str | None = None,
        cached: int = CACHED_WORDS,
        cache: dict[str, bytes] | None = None,
    ):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        added = (t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.parts = _usual_parts()
        self.unusual = re.compile("[^\t\n\r -~¡-ɏ]")
        self.blank = re.compile(r"(?<=[^\t\n\r ])[\t\n\r ]")
        self.cached = cached
        self.cache = {} if cache is None else cache

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _segments(self, text: str) -> Iterable[str]:
        """Parts of bounded size, cut where a blank follows something else: no part spans that."""
        at = 0
        while len(text) - at > SEGMENT:
            cut = self.blank.search(text, at + SEGMENT)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def __call__(self, text: str) -> bytes:
        if self.unusual.search(text) or self.added.search(text):
            return self._whole(text)
        return b"".join(map(self._segment, self._segments(text)))

    def _segment(self, text: str) -> bytes:
        parts = self.parts.findall(text)
        ids = list(map(self.cache.get, parts))
        if None in ids:
            places = [k for k, i in enumerate(ids) if i is None]
            new = {parts[k] for k in places}
            if len(self.cache) + len(new) > self.cached:
                self.cache.clear()
            self._learn_words([p for p in new if p[0] == " " and p[1:].isalpha()])
            self._learn([p for p in new if p not in self.cache])
            for k in places:
                ids[k] = self.cache[parts[k]]
        return b"".join(ids)

    def _learn(self, parts: list[str]) -> None:
        encoded = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        for p, e in zip(parts, encoded, strict=True):
            self.cache[p] = np.array(e.ids, "<u4").tobytes()

    def _learn_words(self, words: list[str]) -> None:
        """Words behind a blank are parted again when they are strung together: one call for all."""
        if not words:
            return
        encoded = self.tokenizer.encode("".join(words), add_special_tokens=False)
        ids, numbers = np.array(encoded.ids, "<u4").tobytes(), np.array(encoded.word_ids)
        starts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
        if len(starts) == len(words):
            ends = np.append(starts[1:], len(numbers))
            for w, a, b in zip(words, (4 * starts).tolist(), (4 * ends).tolist(), strict=True):
                self.cache[w] = ids[a:b]


def pieces_of(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter when it is cut."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    starts = [0, *range(first, total, capacity)]
    return [(s, first if s == 0 else capacity) for s in starts]


def tokenized_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of all documents."""
    schema = arrow_schema(PIECES)
    # Empty: a Python worker keeps its copy, and its later tasks find the words of earlier ones.
    known = docs.sparkSession.sparkContext.broadcast({})

    def tokenize(batches):
        encode = Encoder(path, cache=known.value)
        end = end_id.to_bytes(4, "little")
        for b in batches:
            rows = []
            for doc_id, text in zip(
                b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True
            ):
                ids = encode(text or "") + end
                for k, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, k, start, length, crc))
            yield batch(schema, list(zip(*rows, strict=True)) or [()] * 5)

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(tokenize, PIECES)


class Bins:
    """Sequences of one shard: the pieces in each, and where there is room."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.held: list[list[int]] = []
        self.free: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence with room."""
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        there = 0  # bit r: a sequence with r free places exists
        for k in sorted(range(len(self.lengths)), key=lambda k: -self.lengths[k]):
            size = self.lengths[k]
            fits = there >> size
            if fits:
                r = size + (fits & -fits).bit_length() - 1
                b = room[r].pop()
                if not room[r]:
                    there ^= 1 << r
                self.held[b].append(k)
                self.free[b] -= size
            else:
                b = len(self.held)
                self.held.append([k])
                self.free.append(self.capacity - size)
            if self.free[b]:
                room[self.free[b]].append(b)
                there |= 1 << self.free[b]

    def improve(self) -> None:
        """Exchanges between underfull sequences, from the emptiest up, until none is left."""
        self.offering = defaultdict(set)  # (room, less) -> sequences offering it, see _offers
        self.offered = [0] * (self.capacity + 1)  # by room; bit l: (room, l) is offered
        for b, free in enumerate(self.free):
            if free:
                self._offer(b)
        changed = True
        while changed:
            changed = False
            under = (b for b, f in enumerate(self.free) if f and self.held[b])
            for a in sorted(under, key=lambda b: -self.free[b]):
                if not self.free[a]:  # full since
                    continue
                self._withdraw(a)
                while self._leave(a):
                    changed = True
                self._offer(a)

    def _offers(self, b: int) -> Iterable[int]:
        """The sizes that none, one or two pieces of a sequence have together: what it can give
        back. As much room as that and its free places is then there for another piece."""
        held = Counter(self.lengths[k] for k in self.held[b])
        sizes = {0, *held, *(2 * n for n, times in held.items() if times > 1)}
        return sizes.union(x + y for x, y in combinations(held, 2))

    def _offer(self, b: int) -> None:
        if self.held[b] and self.free[b]:  # empty ones are gone, full ones out of the search
            for less in self._offers(b):
                room = self.free[b] + less
                self.offering[room, less].add(b)
                self.offered[room] |= 1 << less

    def _withdraw(self, b: int) -> None:
        for less in self._offers(b):
            room = self.free[b] + less
            self.offering[room, less].discard(b)
            if not self.offering[room, less]:
                del self.offering[room, less]
                self.offered[room] &= ~(1 << less)

    def _leave(self, a: int) -> bool:
        """Get a piece out of sequence ``a`` in exchange for as little as there is, if any raises
        the squares: the room it goes to must be less than the piece and ``a``'s free places."""
        for k in sorted(self.held[a], key=lambda k: -self.lengths[k]):
            size = self.lengths[k]
            smaller = (1 << size) - 1
            best = None
            for room in range(size, min(size + self.free[a], self.capacity + 1)):
                fits = self.offered[room] & smaller
                if fits:
                    less = (fits & -fits).bit_length() - 1
                    if best is None or less < best[1]:
                        best = room, less
                    if not less:  # a move
                        break
            if best:
                b = next(iter(self.offering[best]))
                self._swap(a, k, b, self._pieces(b, best[1]))
                return True
        return False

    def _pieces(self, b: int, size: int) -> list[int]:
        """No, one or two pieces of a sequence with this size together."""
        if not size:
            return []
        at: dict[int, int] = {}
        for k in self.held[b]:
            if self.lengths[k] == size:
                return [k]
        for k in self.held[b]:
            if size - self.lengths[k] in at:
                return [at[size - self.lengths[k]], k]
            at[self.lengths[k]] = k
        raise AssertionError("not offered")

    def _swap(self, a: int, k: int, b: int, back: list[int]) -> None:
        self._withdraw(b)
        less = self.lengths[k] - sum(self.lengths[j] for j in back)
        self.held[a] = [j for j in self.held[a] if j != k] + back
        self.held[b] = [j for j in self.held[b] if j not in back] + [k]
        self.free[a] += less
        self.free[b] -= less
        self._offer(b)


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Sequence and offset of every piece of one shard."""
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.improve()
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for b, held in enumerate(x for x in bins.held if x):
        at = 0
        for k in held:
            sequence[k], offset[k] = b, at
            at += lengths[k]
    return sequence, offset


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    path: str | None = None,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset`` there."""
    spark = docs.sparkSession
    numbered = tokenized_pieces(docs, capacity, end_id, path).withColumn(
        "row", F.monotonically_increasing_id()
    )
    pieces = staging(spark)(numbered, "pieces")  # stored: a row keeps its number
    shards = max(1, math.ceil(pieces.count() / shard_pieces))
    packed = fields(("shard", "int"), *[(f.name, "int" if f.name == "piece" else "long")
                                        for f in PIECES], ("sequence_id", "long"),
                    ("offset", "long"))

    def pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "start"], ignore_index=True)
        sequence, offset = pack_lengths(rows["length"].tolist(), capacity)
        base = int(rows["shard"].iloc[0]) << 40
        return rows.assign(sequence_id=[base + s for s in sequence], offset=offset)

    deal = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    return (
        pieces.withColumn("shard", deal)
        .drop("row")
        .groupBy("shard")
        .applyInPandas(pack_shard, packed)
        .drop("shard")
    )
