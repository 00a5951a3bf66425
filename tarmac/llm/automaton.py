"""Deterministic automata over bytes: many patterns, compiled into one transition array.

A pattern is read into a small nondeterministic automaton, made deterministic by subset
construction over classes of equivalent bytes, and minimised by partition refinement.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEAD = -1


@dataclass
class Nfa:
    """States are numbers; ``empty`` has moves without a byte, ``moves`` those on a set of bytes."""

    empty: list[list[int]]
    moves: list[list[tuple[frozenset[int], int]]]

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1


    def turned(self) -> Nfa:
        """The same states with every move the other way."""
        out = Nfa([[] for _ in self.empty], [[] for _ in self.moves])
        for q, (empty, moves) in enumerate(zip(self.empty, self.moves, strict=True)):
            for to in empty:
                out.empty[to].append(q)
            for letters, to in moves:
                out.moves[to].append((letters, q))
        return out


class Pattern:
    """Reads literals, ``\\xNN``, classes, groups, ``|`` and the quantifiers ``? * + {m} {m,} {m,n}``."""

    def __init__(self, nfa: Nfa, text: str, fold: bool = False):
        self.nfa, self.text, self.at, self.fold = nfa, text, 0, fold

    def build(self) -> tuple[int, int]:
        ends = self.either()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} in {self.text!r}")
        return ends

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def either(self) -> tuple[int, int]:
        options = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            options.append(self.sequence())
        if len(options) == 1:
            return options[0]
        start, end = self.nfa.state(), self.nfa.state()
        for a, b in options:
            self.nfa.empty[start].append(a)
            self.nfa.empty[b].append(end)
        return start, end

    def sequence(self) -> tuple[int, int]:
        start = end = self.nfa.state()
        while self.peek() not in ("", "|", ")"):
            began = self.at
            piece = self.piece()
            least, most = self.quantifier()
            after = self.at
            for i in range(most if most is not None else max(least, 1)):
                if i:
                    self.at = began
                    piece = self.piece()
                    self.at = after
                if i >= least:
                    self.nfa.empty[piece[0]].append(piece[1])
                self.nfa.empty[end].append(piece[0])
                end = piece[1]
            if most is None:
                self.nfa.empty[end].append(piece[0])
        return start, end

    def quantifier(self) -> tuple[int, int | None]:
        c = self.peek()
        if c and c in "?*+":
            self.at += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if c != "{":
            return 1, 1
        close = self.text.index("}", self.at)
        low, comma, high = self.text[self.at + 1 : close].partition(",")
        self.at = close + 1
        return int(low), (int(high) if high else None) if comma else int(low)

    def piece(self) -> tuple[int, int]:
        c = self.peek()
        if c == "(":
            self.at += 1
            if self.text.startswith("?:", self.at):
                self.at += 2
            inside = self.either()
            if self.peek() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self.at += 1
            # The piece may be linked to itself: give it ends of its own.
            start, end = self.nfa.state(), self.nfa.state()
            self.nfa.empty[start].append(inside[0])
            self.nfa.empty[inside[1]].append(end)
            return start, end
        allowed = self.byte_class() if c == "[" else frozenset([self.byte()])
        if self.fold:
            swapped = {b ^ 32 for b in allowed if chr(b).isascii() and chr(b).isalpha()}
            allowed |= swapped
        start, end = self.nfa.state(), self.nfa.state()
        self.nfa.moves[start].append((frozenset(allowed), end))
        return start, end

    def byte(self) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "\\":
            c = self.text[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def byte_class(self) -> frozenset[int]:
        self.at += 1
        found: set[int] = set()
        while self.peek() != "]":
            low = high = self.byte()
            if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                self.at += 1
                high = self.byte()
            found.update(range(low, high + 1))
        self.at += 1
        return frozenset(found)


@dataclass
class Automaton:
    """``table[state, byte]`` is the next state, ``DEAD`` if there is none; state 0 begins.

    ``accepts[state]`` has bit k set if rule k may end there. States that accept something
    have the highest numbers, from ``first_accept`` on.
    """

    table: np.ndarray
    accepts: np.ndarray
    first_accept: int

    def resets(self) -> np.ndarray:
        """Bytes that lead to the first state from everywhere: no match spans one."""
        return (self.table == 0).all(axis=0)

    def longest(self, data: bytes, at: int, stop: int, rows: list[list[int]] | None = None) -> int:
        """The end of the longest match that begins at ``at``, or -1."""
        rows = rows or self.table.tolist()
        state, found = 0, -1
        while at < stop:
            state = rows[state][data[at]]
            if state == DEAD:
                return found
            at += 1
            if state >= self.first_accept:
                found = at
        return found


def compile_rules(rules: list[tuple[str, bool]], search: bool, backward: bool = False) -> Automaton:
    """One automaton for all (pattern, letters in either case) rules.

    With ``search`` a match may begin at every byte, so that one pass sees all matches' ends;
    without it, a match begins where the automaton starts. With ``backward`` it reads from the
    last byte to the first, so that a searching pass sees all matches' starts.
    """
    nfa = Nfa([], [])
    start, ends = nfa.state(), []
    built = [Pattern(nfa, text, fold).build() for text, fold in rules]
    if backward:
        nfa, built = nfa.turned(), [(b, a) for a, b in built]
    for a, b in built:
        nfa.empty[start].append(a)
        ends.append(b)
    closed = _closures(nfa)
    sets = {s for moves in nfa.moves for s, _ in moves}
    groups: dict[tuple, list[int]] = {}
    for b in range(256):
        groups.setdefault(tuple(b in s for s in sets), []).append(b)
    letters = list(groups.values())
    steps = [[(frozenset(k for k, own in enumerate(letters) if own[0] in s), to) for s, to in moves] for moves in nfa.moves]

    first = closed[start]
    number, todo, rows = {first: 0}, [first], []
    while len(rows) < len(todo):
        reached: list[set[int]] = [set(first) if search else set() for _ in letters]
        for q in todo[len(rows)]:
            for ks, to in steps[q]:
                for k in ks:
                    reached[k] |= closed[to]
        row = []
        for target in map(frozenset, reached):
            if not target:
                row.append(DEAD)
                continue
            if target not in number:
                number[target] = len(todo)
                todo.append(target)
            row.append(number[target])
        rows.append(row)
    accepts = np.array([sum(1 << k for k, e in enumerate(ends) if e in s) for s in todo], dtype=np.int64)
    return _minimal(np.array(rows, dtype=np.int32), accepts, letters)


def _closures(nfa: Nfa) -> list[frozenset[int]]:
    out = []
    for q in range(len(nfa.empty)):
        seen, stack = {q}, [q]
        while stack:
            for to in nfa.empty[stack.pop()]:
                if to not in seen:
                    seen.add(to)
                    stack.append(to)
        out.append(frozenset(seen))
    return out


def _minimal(rows: np.ndarray, accepts: np.ndarray, letters: list[list[int]]) -> Automaton:
    """Merge states that no input tells apart, and number accepting ones last."""
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        ahead = np.where(rows == DEAD, DEAD, block[rows])
        finer = np.unique(np.column_stack([block, ahead]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    kinds = block.max() + 1
    sample = np.zeros(kinds, dtype=np.int64)
    sample[block[::-1]] = np.arange(len(block))[::-1]
    order = sorted(range(kinds), key=lambda k: (accepts[sample[k]] != 0, k != block[0], k))
    rank = np.empty(kinds, dtype=np.int32)
    rank[order] = np.arange(kinds)
    table = np.full((kinds, 256), DEAD, dtype=np.int32)
    for k, own in enumerate(letters):
        to = rows[sample, k]
        table[rank[:, None], own] = np.where(to == DEAD, DEAD, rank[block[to]])[:, None]
    accepted = np.zeros(kinds, dtype=np.int64)
    accepted[rank] = accepts[sample]
    return Automaton(table, accepted, int((accepted == 0).sum()))
