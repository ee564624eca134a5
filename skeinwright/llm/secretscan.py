"""Secret scans with one deterministic automaton for all rules.

Rules are regular expressions over bytes. They are parsed, reversed and joined into one
nondeterministic automaton, which subset construction over classes of bytes makes deterministic and
partition refinement makes minimal; the result is an array of transitions with a mask of rules for each
state. One pass over a text's bytes, from the last to the first, marks for every rule where a match can
begin. From the leftmost mark at or behind the last match's end a forward automaton of that rule finds
the longest match. Matches of a rule don't overlap; one that fails its length test is dropped after it
has taken its place. For the rules here the longest match is also the one that a backtracking search
takes, since no rule leaves a choice where a part ends.

Defined results: a null or empty text has no spans. Offsets count code points, ends exclusive. Rows are
independent, so ties, repeated rows and empty tables need nothing special; only the text column is read,
and the result is one new column.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, once


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int
    any_case: bool = False
    #: ``least`` counts the bytes of the assigned value alone
    value: bool = False


#: The rules (fixed values); the first three are the base rules, whose lengths are tested afterwards.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=\-]+)""", 12, any_case=True, value=True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]\-[A-Za-z0-9\-]+", 15),
    Rule("gcp", r"AIza[0-9A-Za-z_\-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", 30),
    Rule("pem", r"\-\-\-\-\-BEGIN [A-Z ]*PRIVATE KEY\-\-\-\-\-", 1),
)
BASE = ("assign", "access", "hex")


# A syntax tree: ("set", frozenset of bytes), ("seq", [...]), ("alt", [...]), ("rep", node, least, most or None)


def parse(pattern: str, any_case: bool = False) -> tuple:
    """Literals, classes, groups, |, ?, *, +, {m,n} and \\x escapes; bytes of ASCII."""
    at = 0

    def peek() -> str:
        return pattern[at] if at < len(pattern) else ""

    def take() -> str:
        nonlocal at
        at += 1
        return pattern[at - 1]

    def fold(values: set[int]) -> frozenset[int]:
        if any_case:
            values = values | {ord(c) for v in values if v < 128 for c in (chr(v).lower(), chr(v).upper())}
        return frozenset(values)

    def escape() -> int:
        c = take()
        if c == "x":
            return int(take() + take(), 16)
        if c.isalnum():
            raise ValueError(f"escape \\{c} is not known")
        return ord(c)

    def group_set() -> frozenset[int]:
        negated = peek() == "^" and bool(take())
        values: set[int] = set()
        while peek() != "]":
            c = take()
            low = escape() if c == "\\" else ord(c)
            if peek() == "-" and pattern[at + 1] != "]":
                take()
                c = take()
                values |= set(range(low, (escape() if c == "\\" else ord(c)) + 1))
            else:
                values.add(low)
        take()
        return frozenset(range(256)) - fold(values) if negated else fold(values)

    def atom() -> tuple:
        c = take()
        if c == "(":
            inner = choice()
            if take() != ")":
                raise ValueError("a group is not closed")
            return inner
        if c == "[":
            return "set", group_set()
        if c == ".":
            return "set", frozenset(range(256)) - {10}
        return "set", fold({escape() if c == "\\" else ord(c)})

    def repeated() -> tuple:
        node = atom()
        while peek() and peek() in "?*+{":
            c = take()
            if c == "{":
                text = ""
                while peek() != "}":
                    text += take()
                take()
                low, comma, high = text.partition(",")
                node = "rep", node, int(low), (int(high) if high else None) if comma else int(low)
            else:
                node = "rep", node, int(c == "+"), 1 if c == "?" else None
        return node

    def choice() -> tuple:
        options, row = [], []
        while True:
            if not peek() or peek() in "|)":
                options.append(("seq", row))
                row = []
                if peek() != "|":
                    return options[0] if len(options) == 1 else ("alt", options)
                take()
            else:
                row.append(repeated())

    tree = choice()
    if at < len(pattern):
        raise ValueError("an unopened group is closed")
    return tree


def reverse(node: tuple) -> tuple:
    """The tree whose words are the mirrored ones."""
    if node[0] == "seq":
        return "seq", [reverse(x) for x in reversed(node[1])]
    if node[0] == "alt":
        return "alt", [reverse(x) for x in node[1]]
    return ("rep", reverse(node[1]), *node[2:]) if node[0] == "rep" else node


class NFA:
    """States with edges on byte sets and on nothing."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def add(self, node: tuple, start: int) -> int:
        """Builds a node behind ``start``; gives its end."""
        if node[0] == "set":
            end = self.state()
            self.edges[start].append((node[1], end))
            return end
        if node[0] == "seq":
            for x in node[1]:
                start = self.add(x, start)
            return start
        if node[0] == "alt":
            end = self.state()
            for x in node[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(x, first)].append(end)
            return end
        _, inner, least, most = node
        for _ in range(least):
            start = self.add(inner, start)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(inner, loop)].append(loop)
            return loop
        end = self.state()
        for _ in range(most - least):
            self.free[start].append(end)
            start = self.add(inner, start)
        self.free[start].append(end)
        return end

    def closure(self, states: set[int]) -> frozenset[int]:
        seen, pending = set(states), list(states)
        while pending:
            for x in self.free[pending.pop()]:
                if x not in seen:
                    seen.add(x)
                    pending.append(x)
        return frozenset(seen)


@dataclass
class DFA:
    """Transitions (states x 256), the rules that each state accepts as a mask, the start, and a state
    that nothing leaves, or -1."""

    steps: np.ndarray
    masks: np.ndarray
    start: int
    dead: int

    def rows(self) -> list[list]:
        """Each state as a list of the lists that its bytes lead to, its mask at 256."""
        lists: list[list] = [[] for _ in self.masks]
        for own, steps, mask in zip(lists, self.steps.tolist(), self.masks.tolist(), strict=True):
            own.extend([lists[x] for x in steps])
            own.append(mask)
        return lists


def compile_rules(trees: list[tuple], anywhere: bool) -> DFA:
    """Subset construction over byte classes, then minimisation. anywhere: words may begin at any byte."""
    nfa = NFA()
    start = nfa.state()
    final = {}
    for i, tree in enumerate(trees):
        first = nfa.state()
        nfa.free[start].append(first)
        final[nfa.add(tree, first)] = 1 << i
    sets = list({s for edges in nfa.edges for s, _ in edges})
    classes: dict[tuple, list[int]] = {}
    for b in range(256):
        classes.setdefault(tuple(b in s for s in sets), []).append(b)
    groups = list(classes.values())
    root = nfa.closure({start})
    number, order, table = {root: 0}, [root], []
    for states in order:
        row = []
        for group in groups:
            b = group[0]
            after = {t for s in states for on, t in nfa.edges[s] if b in on}
            if anywhere:
                after.add(start)
            goal = nfa.closure(after)
            if goal not in number:
                number[goal] = len(order)
                order.append(goal)
            row.append(number[goal])
        table.append(row)
    steps = np.array(table)
    masks = np.array([sum(m for s, m in final.items() if s in states) for states in order])
    block = np.unique(masks, return_inverse=True)[1].reshape(-1)
    while True:  # states are one while they accept alike and step to the same blocks
        signature = np.column_stack([block, block[steps]])
        refined = np.unique(signature, axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == block.max():
            break
        block = refined
    kept = np.unique(block, return_index=True)[1]
    small = block[steps[kept]]
    full = np.empty((len(kept), 256), np.int32)
    for column, group in enumerate(groups):
        full[:, group] = small[:, [column]]
    masks = masks[kept]
    sink = [s for s in range(len(kept)) if not masks[s] and (full[s] == s).all()]
    return DFA(full, masks, int(block[0]), sink[0] if sink else -1)


class Scanner:
    """All rules, compiled."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        trees = [parse(r.pattern, r.any_case) for r in rules]
        self.combined = compile_rules([reverse(t) for t in trees], anywhere=True)
        rows = self.combined.rows()
        self.root = rows[self.combined.start]
        self.forward = []
        for tree in trees:
            dfa = compile_rules([tree], anywhere=False)
            lists = dfa.rows()
            self.forward.append((lists[dfa.start], lists[dfa.dead] if dfa.dead >= 0 else None))

    def _longest(self, rule: int, data: bytes, start: int) -> int:
        row, dead = self.forward[rule]
        best = start
        for at in range(start, len(data)):
            row = row[data[at]]
            if row is dead:
                break
            if row[256]:
                best = at + 1
        return best

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of every match, in bytes, by start and then rule."""
        marks = np.frombuffer(bytes(map(itemgetter(256), accumulate(data[::-1], getitem, initial=self.root))), np.uint8)[::-1]
        places = np.flatnonzero(marks)
        if not len(places):
            return []
        found = []
        for i, rule in enumerate(self.rules):
            end = 0
            for start in places[(marks[places] >> i & 1) == 1].tolist():
                if start < end:
                    continue
                end = self._longest(i, data, start)
                if end - (_value_start(data, start, end) if rule.value else start) >= rule.least:
                    found.append((start, i, end))
        return sorted(found)


def _value_start(data: bytes, start: int, end: int) -> int:
    """Where the value of an assignment begins: behind the key, one separator, spaces and a quote."""
    at = start
    while data[at] not in b":=":
        at += 1
    at += 1
    while at < end and data[at] == 0x20:
        at += 1
    return at + (data[at] in b"\"'")


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
SPANS = "array<struct<kind:string,start:int,end:int>>"


def spans_of(data: bytes | None) -> list[dict]:
    """Spans in code points."""
    if not data:
        return []
    tool = scanner()
    found = tool.scan(data)
    if not found:
        return []
    if data.isascii():
        point = lambda x: x
    else:
        heads = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)])
        point = lambda x: int(heads[x])
    return [{"kind": tool.rules[i].kind, "start": point(a), "end": point(b)} for a, i, b in found]


def _spans(texts: pa.Array) -> pa.Array:
    return pa.array([spans_of(t) for t in texts.to_pylist()], _SPANS)


def find_secrets(df: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """Adds the spans of every rule's matches."""
    bound_batches(df.sparkSession)
    return df.withColumn(out, once(_spans, SPANS)(F.col(text).cast("binary")))


def redact(text: str, spans: list[dict]) -> str:
    """Each span, or run of overlapping spans, becomes ``[kind]`` of the first."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind']}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def _redacted(texts: pa.Array) -> pa.Array:
    out = []
    for t in texts.to_pylist():
        spans = spans_of(t.encode() if t else None)
        out.append({"spans": spans, "redacted": redact(t, spans) if spans else None})
    return pa.array(out, pa.struct([("spans", _SPANS), ("redacted", pa.string())]))


def redact_secrets(df: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """The text column with its secrets replaced; adds the spans, in the text as it was."""
    bound_batches(df.sparkSession)
    found = df.withColumn(out, once(_redacted, f"struct<spans:{SPANS},redacted:string>")(F.col(text)))
    return found.withColumn(text, F.coalesce(F.col(f"{out}.redacted"), F.col(text))).withColumn(out, F.col(f"{out}.spans"))
