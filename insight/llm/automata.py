"""Regular expressions to minimal byte automata: subset construction, then partition refinement.

Covers what secret rules need: literals, classes, groups, alternation and the
repeats ``? * + {m} {m,} {m,n}`` over single-byte characters. Parsing is left
to the standard library's own regex parser; this module turns its tree into a
nondeterministic automaton, that into a deterministic one and minimises it.
"""

from __future__ import annotations

import re

_parser = re._parser  # the parse tree of a pattern, as `re` itself compiles it


class Nfa:
    """States are integers; ``eps`` and ``on`` hold the moves."""

    def __init__(self) -> None:
        self.eps: list[list[int]] = []
        self.on: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.eps.append([])
        self.on.append([])
        return len(self.eps) - 1

    def add(self, tree, start: int, fold: bool) -> int:
        """Add a parse tree behind ``start``; returns the state after it."""
        for op, arg in tree:
            name = str(op)
            if name in ("LITERAL", "NOT_LITERAL", "IN", "ANY"):
                end = self.state()
                self.on[start].append((charset(name, arg, fold), end))
                start = end
            elif name == "SUBPATTERN":
                start = self.add(arg[3], start, fold)
            elif name == "BRANCH":
                end = self.state()
                for alternative in arg[1]:
                    self.eps[self.add(alternative, start, fold)].append(end)
                start = end
            elif name == "MAX_REPEAT":
                least, most, body = arg
                for _ in range(least):
                    start = self.add(body, start, fold)
                if most is _parser.MAXREPEAT:
                    loop = self.state()
                    self.eps[start].append(loop)
                    self.eps[self.add(body, loop, fold)].append(loop)
                    start = loop
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.eps[start].append(end)
                        start = self.add(body, start, fold)
                    self.eps[start].append(end)
                    start = end
            else:
                raise ValueError(f"{name} is not a regular operation over bytes")
        return start

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def charset(name: str, arg, fold: bool) -> frozenset[int]:
    """The bytes that one character of a pattern stands for."""
    if name == "ANY":
        return frozenset(range(256)) - {10}
    if name in ("LITERAL", "NOT_LITERAL"):
        items, negated = [("LITERAL", arg)], name == "NOT_LITERAL"
    else:
        items, negated = [(str(o), a) for o, a in arg], False
        if items[0][0] == "NEGATE":
            items, negated = items[1:], True
    out: set[int] = set()
    for kind, value in items:
        if kind == "LITERAL":
            out.add(value)
        elif kind == "RANGE":
            out.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"{kind} is not a plain class")
    if fold:
        out |= {b ^ 32 for b in out if chr(b).isascii() and chr(b).isalpha()}
    if max(out, default=0) > 127:
        raise ValueError("patterns are over single-byte characters")
    return frozenset(range(256)) - out if negated else frozenset(out)


class Dfa:
    """``table[state * 256 + byte]`` is the next state; ``marks[state]`` the bits of rules that end there."""

    def __init__(self, rows: list[list[int]], marks: list[int], classes: list[int]) -> None:
        self.table = [row[c] for row in rows for c in classes]
        self.marks = marks

    def __len__(self) -> int:
        return len(self.marks)


def byte_classes(nfa: Nfa) -> tuple[list[int], list[int]]:
    """Bytes that no move tells apart share a class: the class of each byte, and one byte of each."""
    sets = {chars for moves in nfa.on for chars, _ in moves}
    seen: dict[tuple, int] = {}
    classes = [seen.setdefault(tuple(b in chars for chars in sets), len(seen)) for b in range(256)]
    return classes, [classes.index(c) for c in range(len(seen))]


def compile_rules(patterns: list[tuple[str, bool]], anywhere: bool, reverse: bool = False) -> Dfa:
    """Minimal automaton of several ``(pattern, ignore case)`` rules; rule i marks bit i.

    ``anywhere`` lets a match begin at every byte. ``reverse`` compiles the
    reversed patterns, to walk from a match's end to its starts.
    """
    nfa = Nfa()
    root = nfa.state()
    ends = {}
    for i, (pattern, fold) in enumerate(patterns):
        tree = _parser.parse(pattern)
        first = nfa.state()
        nfa.eps[root].append(first)
        ends[nfa.add(_reversed(tree) if reverse else tree, first, fold)] = 1 << i
    classes, samples = byte_classes(nfa)
    start = nfa.closure([root])
    ids, rows, marks, todo, memo = {start: 0}, [], [], [start], {}
    while todo:
        here = todo.pop(0)
        marks.append(sum({ends[s] for s in here if s in ends}))
        moves = [(chars, t) for s in here for chars, t in nfa.on[s]]
        row = []
        for b in samples:
            key = frozenset(t for chars, t in moves if b in chars)
            if key not in memo:
                memo[key] = nfa.closure(key) | start if anywhere else nfa.closure(key)
            to = memo[key]
            if to not in ids:
                ids[to] = len(ids)
                todo.append(to)
            row.append(ids[to])
        rows.append(row)
    return _minimal(rows, marks, classes)


def _reversed(tree) -> list:
    """A parse tree with every sequence in reverse order."""
    out = []
    for op, arg in reversed(list(tree)):
        name = str(op)
        if name == "SUBPATTERN":
            arg = (*arg[:3], _reversed(arg[3]))
        elif name == "BRANCH":
            arg = (arg[0], [_reversed(a) for a in arg[1]])
        elif name == "MAX_REPEAT":
            arg = (arg[0], arg[1], _reversed(arg[2]))
        out.append((op, arg))
    return out


def _minimal(rows: list[list[int]], marks: list[int], classes: list[int]) -> Dfa:
    """Merge states that no input tells apart, by refining the partition until it is stable."""
    block = list(marks)
    while True:
        seen: dict[tuple, int] = {}
        new = [seen.setdefault((block[s], *[block[t] for t in row]), len(seen)) for s, row in enumerate(rows)]
        if len(seen) == len(set(block)):
            break
        block = new
    # the start state's block comes first; within, by first member
    first: dict[int, int] = {}
    for s, b in enumerate(new):
        first.setdefault(b, s)
    order = {b: i for i, b in enumerate(first)}
    return Dfa([[order[new[t]] for t in rows[s]] for s in first.values()], [marks[s] for s in first.values()], classes)
