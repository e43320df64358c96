"""Secret scans with one deterministic automaton for all rules.

The rules' regular expressions are compiled on the driver: a nondeterministic automaton per rule,
subset construction over all of them together, minimisation by partition refinement, flat
transition arrays over byte classes. The combined automaton reads every text once, from its last
byte to its first, over the reversed rules: wherever it accepts, a match of the named rules
starts. From such a place a small forward automaton per rule walks to the longest end. Matches are
leftmost, longest and do not overlap within a rule; ``keep`` then drops those that are too short.

Cost per text is one table step per byte plus the bytes of the matches; memory is the text, the
starts and the tables. There is no shuffle.

Defined results: a null text is empty and has no spans. Offsets are code points, the end is
exclusive. Spans are ordered by start, then rule order. Rows are independent, repeats included;
other columns pass through unchanged where texts are masked. Texts are valid UTF-8, rules match
bytes (so classes name ASCII characters).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from re import _parser as regex_syntax

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimlink.llm.common import arrow_schema, batch, fields, texts

ALL_BYTES = (1 << 256) - 1
SEGMENT = 1 << 18  # bytes whose starts a task holds at a time


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match shorter than ``least`` characters is dropped; with ``tail`` only
    the characters of that class at its end count."""

    kind: str
    pattern: str
    least: int = 0
    tail: str | None = None


# The kinds and patterns that results are defined by.
BASE_RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
        r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
        r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        least=8,
        tail="assigned",
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
EXTRA_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("service_token", r"(ghp|gho|ghs|ghu)_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + EXTRA_RULES
_VALUE = re.compile(rb"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)\Z""")


# ---------------------------------------------------------------- compilation
class _Graph:
    """Nondeterministic automaton: empty moves and moves on a set of bytes (a 256-bit mask)."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[int, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, items, start: int, backward: bool) -> int:
        """Append a parsed expression behind ``start``; its last state."""
        for op, value in reversed(list(items)) if backward else items:
            start = self._one(str(op), value, start, backward)
        return start

    def _one(self, op: str, value, start: int, backward: bool) -> int:
        if op in ("LITERAL", "NOT_LITERAL", "IN", "ANY"):
            end = self.state()
            self.moves[start].append((_mask(op, value), end))
            return end
        if op == "SUBPATTERN":
            return self.add(value[-1], start, backward)
        if op == "BRANCH":
            end = self.state()
            for branch in value[1]:
                inner = self.state()
                self.empty[start].append(inner)
                self.empty[self.add(branch, inner, backward)].append(end)
            return end
        if op == "MAX_REPEAT":
            least, most, inner = value
            for _ in range(least):
                start = self.add(inner, start, backward)
            if most is regex_syntax.MAXREPEAT:
                loop = self.state()
                self.empty[start].append(loop)
                self.empty[self.add(inner, loop, backward)].append(loop)
                return loop
            end = self.state()
            self.empty[start].append(end)
            for _ in range(most - least):
                start = self.add(inner, start, backward)
                self.empty[start].append(end)
            return end
        raise ValueError(f"not supported in a rule: {op}")

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(s for s in seen)


def _mask(op: str, value) -> int:
    if op == "LITERAL":
        return 1 << value
    if op == "NOT_LITERAL":
        return ALL_BYTES ^ (1 << value)
    if op == "ANY":
        return ALL_BYTES ^ (1 << 10)
    mask, inverted = 0, False
    for kind, x in value:
        if str(kind) == "NEGATE":
            inverted = True
        elif str(kind) == "LITERAL":
            mask |= 1 << x
        elif str(kind) == "RANGE":
            mask |= (1 << (x[1] + 1)) - (1 << x[0])
        else:
            raise ValueError(f"not supported in a class: {kind}")
    return ALL_BYTES ^ mask if inverted else mask


@dataclass(frozen=True)
class Automaton:
    """``step[state + classes[byte]]`` is the next state; states count in multiples of the number
    of classes, those from ``accepting`` on accept, 0 is the start. ``marks`` names the rules an
    accepting state stands for, a bit each. ``dead`` cannot accept any more (-1: none)."""

    classes: bytes
    step: list[int]
    accepting: int
    marks: dict[int, int]
    start: int
    dead: int


def compile_rules(patterns: Sequence[str], backward: bool, anywhere: bool) -> Automaton:
    """One minimal deterministic automaton for all patterns.

    ``backward`` reads them from their last byte; ``anywhere`` lets a match begin at every byte.
    """
    graph = _Graph()
    begin = graph.state()
    ends: dict[int, int] = {}
    for rule, pattern in enumerate(patterns):
        start = graph.state()
        graph.empty[begin].append(start)
        parsed = regex_syntax.parse(pattern.encode())
        ends[graph.add(parsed, start, backward)] = 1 << rule

    masks = sorted({m for moves in graph.moves for m, _ in moves})
    signatures = [tuple(m >> b & 1 for m in masks) for b in range(256)]
    kinds = {s: i for i, s in enumerate(dict.fromkeys(signatures))}
    classes = bytes(kinds[s] for s in signatures)
    sample = [signatures.index(s) for s in kinds]

    first = graph.closure([begin])
    closures = [graph.closure([s]) for s in range(len(graph.empty))]
    useful = [bool(graph.moves[s]) or s in ends for s in range(len(graph.empty))]

    def core(states) -> frozenset[int]:
        return frozenset(s for s in states if useful[s])

    seen = {core(first): 0}
    order, step = [core(first)], []
    for states in order:  # grows while it is read
        moves = [m for s in states for m in graph.moves[s]]
        row = []
        for byte in sample:
            target = set(first) if anywhere else set()
            for mask, t in moves:
                if mask >> byte & 1:
                    target |= closures[t]
            target = core(target)
            if target not in seen:
                seen[target] = len(order)
                order.append(target)
            row.append(seen[target])
        step.append(row)

    marks = np.array([sum(ends.get(s, 0) for s in states) for states in order])
    table = np.array(step, dtype=np.int64)
    group, n = np.unique(marks, return_inverse=True)[1], 0
    while group.max() + 1 != n:  # split groups until all members agree on where they go
        n = group.max() + 1
        group = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)[1]
        group = group.reshape(-1)
    member = np.zeros(n, dtype=np.int64)
    member[group] = np.arange(len(order))
    accepts = marks[member] > 0
    place = np.empty(n, dtype=np.int64)
    place[np.argsort(accepts, kind="stable")] = np.arange(n)  # accepting states last
    width = len(kinds)
    small = np.empty((n, width), dtype=np.int64)
    small[place] = place[group[table[member]]] * width
    stuck = [s for s in range(n) if (small[s] == s * width).all() and s < (~accepts).sum()]
    return Automaton(
        classes,
        small.reshape(-1).tolist(),
        int((~accepts).sum()) * width,
        {int(place[g]) * width: int(marks[member[g]]) for g in range(n) if accepts[g]},
        int(place[group[0]]) * width,
        stuck[0] * width if stuck and not anywhere else -1,
    )


@lru_cache(maxsize=8)
def compiled(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Automaton]]:
    """The combined backward automaton and a forward one for each rule."""
    every = compile_rules([r.pattern for r in rules], backward=True, anywhere=True)
    return every, [compile_rules([r.pattern], backward=False, anywhere=False) for r in rules]


# ---------------------------------------------------------------- scanning
def starts_of(text: bytes, machine: Automaton) -> Iterator[tuple[int, int]]:
    """(start, rules) of all places where a match starts, from the first to the last.

    The automaton reads from the end. A long text is read once for the states at the segments'
    ends, then segment by segment from the first, so that only one segment's starts are held.
    """
    step, accepting, marks = machine.step, machine.accepting, machine.marks
    cuts = range(0, len(text), SEGMENT)
    states = [machine.start] * len(cuts)  # with which the scan comes into each segment
    for k in reversed(range(1, len(cuts))):
        state = states[k]
        for c in text[cuts[k] : cuts[k] + SEGMENT].translate(machine.classes)[::-1]:
            state = step[state + c]
        states[k - 1] = state
    for at, state in zip(cuts, states, strict=True):
        segment = text[at : at + SEGMENT].translate(machine.classes)
        found, place = [], at + len(segment)
        for c in segment[::-1]:
            place -= 1
            state = step[state + c]
            if state >= accepting:
                found.append((place, marks[state]))
        yield from reversed(found)


def longest(text: bytes, start: int, machine: Automaton) -> int:
    """End of the longest match that starts at ``start``."""
    step, state, end = machine.step, machine.start, start
    classes, accepting, dead = machine.classes, machine.accepting, machine.dead
    for place in range(start, len(text)):
        state = step[state + classes[text[place]]]
        if state >= accepting:
            end = place + 1
        elif state == dead:
            break
    return end


def _kept(rule: Rule, match: bytes) -> bool:
    if rule.tail == "assigned":
        value = _VALUE.search(match)
        return value is not None and len(value[1]) >= rule.least
    return len(match) >= rule.least


def spans_of(text: bytes, rules: tuple[Rule, ...], machines) -> list[tuple[int, int, int]]:
    """(start, end, rule) in bytes, by start and rule."""
    every, forward = machines
    spans, free = [], [0] * len(rules)
    for start, marks in starts_of(text, every):
        for k, rule in enumerate(rules):
            if marks >> k & 1 and start >= free[k]:
                free[k] = end = longest(text, start, forward[k])
                if _kept(rule, text[start:end]):
                    spans.append((start, end, k))
    return spans


def code_points(text: bytes, places: list[int]) -> list[int]:
    """Byte offsets, ascending, as code point offsets."""
    if text.isascii():
        return places
    out, at, points = [], 0, 0
    for p in places:
        points += len(text[at:p].decode())
        at = p
        out.append(points)
    return out


def _in_points(text: bytes, spans):
    places = sorted({p for s in spans for p in s[:2]})
    points = dict(zip(places, code_points(text, places), strict=True))
    return [(points[a], points[b], k) for a, b, k in spans]


FINDINGS = fields(
    ("doc_id", "long"),
    ("n_assign", "long"),
    ("n_access", "long"),
    ("n_hex", "long"),
    ("base_sha256", "string"),
    ("spans", "string"),
)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, digest and spans (``kind:start:end``, comma-joined) of every document."""
    machines = compiled(rules)
    schema = arrow_schema(FINDINGS)
    base = [r.kind for r in BASE_RULES]

    def scan(batches):
        for b in batches:
            rows = []
            for text in texts(b.column("text")):
                spans = spans_of(text, rules, machines)
                said = [(rules[k].kind, f"{rules[k].kind}:{s}:{e}")
                        for s, e, k in _in_points(text, spans)] if spans else []
                own = ",".join(x for kind, x in said if kind in base)
                kinds = [kind for kind, _ in said]
                rows.append((
                    *[kinds.count(k) for k in base],
                    hashlib.sha256(own.encode()).hexdigest(),
                    ",".join(x for _, x in said),
                ))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield batch(schema, [b.column("doc_id"), *columns])

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(scan, FINDINGS)


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every span replaced by ``[kind]``; ``n_chars`` follows the text."""
    machines = compiled(rules)

    def mask(batches):
        for b in batches:
            raw = b.column("text").cast(pa.binary()).to_pylist()
            sizes = b.column("n_chars").to_pylist() if "n_chars" in b.schema.names else None
            clean = []
            for i, text in enumerate(raw):
                spans = spans_of(text, rules, machines) if text else []
                if spans:
                    parts, at = [], 0
                    for start, end, k in spans:
                        if start >= at:
                            parts += [text[at:start], f"[{rules[k].kind}]".encode()]
                        at = max(at, end)
                    text = b"".join([*parts, text[at:]])
                    if sizes is not None:
                        sizes[i] = len(text.decode())
                clean.append(None if text is None else text.decode())
            new = {"text": clean} if sizes is None else {"text": clean, "n_chars": sizes}
            yield batch(b.schema, [new.get(name, b.column(name)) for name in b.schema.names])

    return docs.mapInArrow(mask, docs.schema)
