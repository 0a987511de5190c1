"""Secret scan: all rules as one minimal automaton, one pass over the bytes.

The combined automaton says at each byte which rules have a match that ends
there. Only at such a byte, a rule's own automaton, read on from the end of the
rule's last match, says whether one that begins behind it ends here; its reversed
automaton finds the leftmost start and its forward one the longest end. Matches of a rule are leftmost, longest, non-overlapping; a
match shorter than its rule asks is used up and dropped. Offsets are code
points, end exclusive.

Defined cases: a null or empty text has no spans; multi-byte characters never
match a rule; repeated rows give repeated results; an empty table gives no
rows. Only the id and text columns are read by ``scan``; ``redact`` passes all
other columns through untouched. A text of any length is
one pass, and one more of a rule behind its first match.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.llm.automata import Dfa, compile_rules
from insight.llm.common import arrow_map, shipped, utf8


@dataclass(frozen=True)
class Rule:
    """A secret kind: pattern, ignore case, pattern of a head not counted, least length after it."""

    kind: str
    pattern: str
    fold: bool = False
    head: str = ""
    least: int = 0


#: Fixed values of the contract; group 2 of `assign` is what follows its head.
ASSIGN_HEAD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE = (
    Rule("assign", ASSIGN_HEAD + r"([A-Za-z0-9+/_.=-]+)", True, ASSIGN_HEAD, 12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
)
#: Kinds of our own: key blocks and tokens with a fixed mark.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)
RULES = BASE + ADDED


def scan_pattern(rule: Rule) -> str:
    """The pattern that the combined pass looks for.

    A lone class repeat, such as hex digits, would end a match at every other
    letter; asking for the least length there keeps the same matches, since
    its matches are maximal runs.
    """
    lone = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return f"{lone[1]}{{{rule.least},}}" if lone and rule.least else rule.pattern


class Scanner:
    """Compiled rules. ``spans`` gives (start, end, rule number) of one text's bytes."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        combined = compile_rules([(scan_pattern(r), r.fold) for r in rules], anywhere=True)
        # states renumbered so that marked ones come last and a state is its table row's offset
        order = sorted(range(len(combined)), key=lambda s: (combined.marks[s] != 0, s))
        place = {s: i * 256 for i, s in enumerate(order)}
        self.table = [place[combined.table[s * 256 + b]] for s in order for b in range(256)]
        self.start = place[0]
        self.marked = 256 * sum(1 for s in order if not combined.marks[s])
        self.bits = {place[s]: [i for i in range(len(rules)) if combined.marks[s] >> i & 1]
                     for s in order if combined.marks[s]}
        self.forward = [compile_rules([(r.pattern, r.fold)], anywhere=False) for r in rules]
        self.backward = [compile_rules([(scan_pattern(r), r.fold)], anywhere=False, reverse=True) for r in rules]
        self.own = [compile_rules([(scan_pattern(r), r.fold)], anywhere=True) for r in rules]
        self.heads = [compile_rules([(r.head, r.fold)], anywhere=False) if r.head else None for r in rules]
        self.dead = {id(d): _dead(d) for d in (*self.forward, *self.backward, *self.heads) if d}

    def _walk(self, dfa: Dfa, data: bytes, at: int, stop: int, step: int) -> int:
        """The farthest place from ``at`` (towards ``stop``) where ``dfa`` accepts, or -1."""
        state, best, dead = 0, -1, self.dead[id(dfa)]
        table, marks = dfa.table, dfa.marks
        while at != stop:
            state = table[state * 256 + data[at if step > 0 else at - 1]]
            if state == dead:
                break
            at += step
            if marks[state]:
                best = at
        return best

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        found: list[tuple[int, int, int]] = []
        after = [0] * len(self.rules)
        fresh = [(0, 0)] * len(self.rules)
        table, state, marked = self.table, self.start, self.marked
        for at, byte in enumerate(data, 1):
            state = table[state + byte]
            if state >= marked:
                for i in self.bits[state]:
                    if at > after[i] and (not after[i] or self._ends(i, data, at, after, fresh)):
                        self._take(i, data, at, after, found)
        return sorted(found, key=lambda m: (m[0], m[2]))

    def _ends(self, i: int, data: bytes, at: int, after: list[int], fresh: list[tuple[int, int]]) -> bool:
        """Whether a match that begins behind the rule's last one ends at ``at``; ``fresh`` keeps how far was read, and the state."""
        here, state = fresh[i] if fresh[i][0] >= after[i] else (after[i], 0)
        table = self.own[i].table
        for byte in data[here:at]:
            state = table[state * 256 + byte]
        fresh[i] = at, state
        return bool(self.own[i].marks[state])

    def _take(self, i: int, data: bytes, at: int, after: list[int], found: list) -> None:
        start = self._walk(self.backward[i], data, at, after[i], -1)
        if start < 0:
            return
        end = self._walk(self.forward[i], data, start, len(data), 1)
        after[i] = end
        body = self._walk(self.heads[i], data, start, end, 1) if self.heads[i] else start
        if end - body >= self.rules[i].least:
            found.append((start, end, i))

    def text_spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """Spans of a text in code points."""
        data = utf8(text)
        found = self.spans(data)
        if not found or data.isascii():
            return found
        cuts = sorted({x for s, e, _ in found for x in (s, e)})
        place, last, points = {}, 0, 0
        for c in cuts:
            points += len(data[last:c].decode("utf-8", "surrogatepass"))
            place[c], last = points, c
        return [(place[s], place[e], i) for s, e, i in found]


def _dead(dfa: Dfa) -> int:
    """The state that only leads to itself and accepts nothing, or -1."""
    return next((s for s in range(len(dfa)) if not dfa.marks[s]
                 and all(t == s for t in dfa.table[s * 256:s * 256 + 256])), -1)


@cache
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """One scanner per Python worker."""
    return Scanner(rules)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: id and ``spans``, an array of (kind, start, end, rule number)."""
    kind = dict(docs.select(id_col).dtypes)[id_col]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("rule", pa.int32())]))

    def run(batch: pa.RecordBatch) -> dict:
        scan_one = scanner(rules).text_spans
        made = [[{"kind": rules[i].kind, "start": s, "stop": e, "rule": i} for s, e, i in scan_one(t)]
                for t in batch.column(1).to_pylist()]
        return {id_col: batch.column(0), "spans": pa.array(made, span)}

    return arrow_map(docs.select(id_col, text_col), run,
                     f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,stop:bigint,rule:int>>")


def redacted(text: str | None, rules: tuple[Rule, ...] = RULES) -> str | None:
    """The text with every secret replaced by ``[kind]``; overlapping spans become one."""
    spans = scanner(rules).text_spans(text)
    if not spans:
        return text
    out, at, until = [], 0, -1
    for start, end, i in spans:
        if start >= until:
            out += [text[at:start], f"[{rules[i].kind}]"]
        until = at = max(until, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns, with secrets in the text replaced and its length column set anew."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(redacted, na_action="ignore")

    out = shipped(docs).withColumn(text_col, clean(F.col(text_col)))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(F.col(text_col)).cast(docs.schema[length_col].dataType))
    return out
