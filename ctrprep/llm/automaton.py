"""Byte patterns compiled to one deterministic automaton.

Patterns are written in a small part of the usual notation: literals, ``\\xHH`` and escaped characters, ``[...]``
classes, groups with ``|``, and ``? * + {n} {n,} {n,m}``. All patterns together become one automaton by
subset construction, which Moore's refinement then minimises; the result is a table ``next[state, byte class]``
and, per state, a bit for every pattern that ends there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

Node = tuple


def parse(pattern: str) -> Node:
    """The pattern as nested ``("set", bytes)``, ``("all", nodes)``, ``("any", nodes)``, ``("repeat", node, low, high)``."""
    node, at = _alternatives(pattern, 0)
    if at != len(pattern):
        raise ValueError(f"unexpected {pattern[at]!r} at {at} of {pattern!r}")
    return node


def _alternatives(p: str, at: int) -> tuple[Node, int]:
    options = []
    while True:
        parts = []
        while at < len(p) and p[at] not in "|)":
            part, at = _atom(p, at)
            part, at = _repeated(part, p, at)
            parts.append(part)
        options.append(("all", parts))
        if at >= len(p) or p[at] == ")":
            return ("any", options), at
        at += 1


def _atom(p: str, at: int) -> tuple[Node, int]:
    if p[at] == "(":
        node, at = _alternatives(p, at + 1)
        return node, at + 1
    if p[at] == "[":
        members, at = set(), at + 1
        while p[at] != "]":
            first, at = _character(p, at)
            last = first
            if p[at] == "-" and p[at + 1] != "]":
                last, at = _character(p, at + 1)
            members |= set(range(first, last + 1))
        return ("set", frozenset(members)), at + 1
    byte, at = _character(p, at)
    return ("set", frozenset([byte])), at


def _character(p: str, at: int) -> tuple[int, int]:
    if p[at] != "\\":
        return ord(p[at]), at + 1
    if p[at + 1] == "x":
        return int(p[at + 2 : at + 4], 16), at + 4
    return ord(p[at + 1]), at + 2


def _repeated(node: Node, p: str, at: int) -> tuple[Node, int]:
    if at < len(p) and p[at] in "?*+":
        low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}[p[at]]
        return ("repeat", node, low, high), at + 1
    if at < len(p) and p[at] == "{":
        end = p.index("}", at)
        low, comma, high = p[at + 1 : end].partition(",")
        return ("repeat", node, int(low), (int(high) if high else None) if comma else int(low)), end + 1
    return node, at


def either_case(node: Node) -> Node:
    """The same pattern for letters of either case."""
    if node[0] == "set":
        letters = [b for b in node[1] if chr(b).isascii() and chr(b).isalpha()]
        return ("set", node[1] | {b ^ 0x20 for b in letters})
    if node[0] == "repeat":
        return ("repeat", either_case(node[1]), *node[2:])
    return (node[0], [either_case(x) for x in node[1]])


def reverse(node: Node) -> Node:
    """The pattern of the same strings read backwards."""
    if node[0] == "set":
        return node
    if node[0] == "repeat":
        return ("repeat", reverse(node[1]), *node[2:])
    parts = [reverse(x) for x in node[1]]
    return (node[0], parts[::-1] if node[0] == "all" else parts)


class _Graph:
    """States with empty and byte-set transitions."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, node: Node, start: int) -> int:
        """Append ``node`` behind ``start``; returns the state behind it."""
        if node[0] == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if node[0] == "all":
            for part in node[1]:
                start = self.add(part, start)
            return start
        end = self.state()
        if node[0] == "any":
            for option in node[1]:
                self.empty[self.add(option, start)].append(end)
            return end
        _, part, low, high = node
        for _ in range(low):
            start = self.add(part, start)
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop)].append(loop)
            self.empty[loop].append(end)
            return end
        for _ in range(high - low):
            self.empty[start].append(end)
            start = self.add(part, start)
        self.empty[start].append(end)
        return end

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``table[state * classes + byte_class[byte]]`` is the next state; state 0 is the first."""

    table: np.ndarray
    byte_class: np.ndarray
    classes: int
    accepts: np.ndarray
    dead: int

    def step(self, states: np.ndarray, byte_classes: np.ndarray) -> np.ndarray:
        return self.table[states * self.classes + byte_classes]

    def scan(self, data: np.ndarray, lane: int = 512, warm_up: int = 48) -> np.ndarray:
        """The state behind every byte of ``data``, read from the first state on.

        The text is cut into lanes that are read side by side, one array step per position. A lane starts in
        the state reached from ``warm_up`` bytes before it. Where that was not the state in which the lane before
        ended, true starts follow from where all lanes end from that state, computed once for each such state;
        lanes with another start than guessed are then read again, together.
        """
        classes = self.byte_class[data]
        n = len(classes)
        lanes = -(-n // lane)
        if not lanes:
            return np.empty(0, np.int32)
        padded = np.zeros(warm_up + lanes * lane, self.byte_class.dtype)
        padded[warm_up : warm_up + n] = classes
        grid = padded[warm_up:].reshape(lanes, lane).T.copy()
        out = np.empty((lane, lanes), np.int32)
        start = np.zeros(lanes, np.int32)
        for k in range(warm_up):
            start[1:] = self.step(start[1:], padded[k + lane :: lane][: lanes - 1])
        self._read(grid, start, np.arange(lanes), out)
        true = self._lane_starts(grid, start, out[-1])
        wrong = np.flatnonzero(true != start)
        if len(wrong):
            self._read(grid, true, wrong, out)
        return out.T.reshape(-1)[:n]

    def _read(self, grid: np.ndarray, start: np.ndarray, which: np.ndarray, out: np.ndarray) -> None:
        """Fill the columns ``which`` of ``out`` with the states behind each place of those lanes."""
        state, every = start[which], len(which) == grid.shape[1]
        for k in range(len(grid)):
            state = self.step(state, grid[k] if every else grid[k, which])
            if every:
                out[k] = state
            else:
                out[k, which] = state

    def _lane_starts(self, grid: np.ndarray, guess: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The state in which each lane starts, given where each ends from a guessed start."""
        true, ends = guess.copy(), {}
        for k in np.flatnonzero(end[:-1] != guess[1:]).tolist():
            # Lanes up to here are settled if an earlier correction ran past them or died out.
            at = k + 1
            state = end[k] if true[k] == guess[k] else ends[int(true[k])][k]
            while at < len(true) and state != true[at]:
                true[at] = state
                known = int(state)
                if known not in ends:
                    reached = np.full(len(true), known, np.int32)
                    for row in grid:
                        reached = self.step(reached, row)
                    ends[known] = reached
                state = end[at] if known == guess[at] else ends[known][at]
                at += 1
        return true


def compile_patterns(nodes: list[Node], anchored: bool = False) -> Automaton:
    """One automaton for all patterns, each found anywhere (or only from the first byte on, if ``anchored``)."""
    graph, root, ends = _Graph(), 0, []
    graph.state()
    for node in nodes:
        first = graph.state()
        graph.empty[root].append(first)
        ends.append(graph.add(node, first))
    of_byte: dict[tuple, int] = {}
    byte_class = np.zeros(256, np.int32)
    sets = list({m for moves in graph.moves for m, _ in moves})
    for b in range(256):
        byte_class[b] = of_byte.setdefault(tuple(b in s for s in sets), len(of_byte))
    examples = [int(np.flatnonzero(byte_class == c)[0]) for c in range(len(of_byte))]

    # Sets of states are bits of a number.
    closed = [sum(1 << t for t in graph.closure({s})) for s in range(len(graph.empty))]
    after = [[_union(closed[t] for m, t in moves if byte in m) for byte in examples] for moves in graph.moves]
    begin = closed[root]
    numbers, rows, todo = {begin: 0}, [], [begin]
    for states in todo:
        row = [0 if anchored else begin] * len(examples)
        for s in _bits(states):
            if graph.moves[s]:
                row = [a | b for a, b in zip(row, after[s], strict=True)]
        for a in row:
            if a not in numbers:
                numbers[a] = len(numbers)
                todo.append(a)
        rows.append([numbers[a] for a in row])
    table = np.array(rows, np.int32)
    accepts = np.array([sum(1 << k for k, e in enumerate(ends) if states >> e & 1) for states in todo], np.int64)
    table, accepts = _minimised(table, accepts)
    loops = np.flatnonzero((table == np.arange(len(table))[:, None]).all(axis=1) & (accepts == 0))
    return Automaton(table.reshape(-1), byte_class, len(examples), accepts, int(loops[0]) if len(loops) else -1)


def _union(sets: Iterable[int]) -> int:
    out = 0
    for x in sets:
        out |= x
    return out


def _bits(states: int) -> Iterator[int]:
    while states:
        low = states & -states
        yield low.bit_length() - 1
        states ^= low


def _minimised(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States that no text tells apart become one; the first state stays number 0."""
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        view = np.column_stack([block, block[table]])
        finer = np.unique(view, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    order = np.full(block.max() + 1, -1)
    firsts = []
    for s, b in enumerate(block):
        if order[b] < 0:
            order[b] = len(firsts)
            firsts.append(s)
    return order[block[table[firsts]]].astype(np.int32), accepts[firsts]
