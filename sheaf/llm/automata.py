"""Probabilistic automata inferred from examples by merging states of a prefix tree (ALERGIA).

The prefix tree counts how many examples pass each prefix. Going outward from the root,
a state is merged with an earlier one whenever the two end and continue with the same
frequencies, as far as a Hoeffding bound can tell, along their whole subtrees.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

#: Classes of characters an automaton reads: hex letters apart, other signs as themselves.
CLASSES = str.maketrans(
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0" * 10 + "a" * 6 + "g" * 20 + "A" * 6 + "G" * 20,
)
ALPHABET = "0agAG+/_.=-"


class _Tree:
    def __init__(self, examples: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        self.through: list[dict[str, int]] = [{}]
        self.ends = [0]
        for example in examples:
            at = 0
            for c in example:
                self.through[at][c] = self.through[at].get(c, 0) + 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.through.append({})
                    self.ends.append(0)
                at = self.next[at][c]
            self.ends[at] += 1

    def count(self, s: int) -> int:
        return self.ends[s] + sum(self.through[s].values())

    def alike(self, a: int, b: int, bound: float) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self.count(a), self.count(b)
            if not n or not m:
                continue
            most = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > most:
                return False
            for c in self.through[a].keys() | self.through[b].keys():
                if abs(self.through[a].get(c, 0) / n - self.through[b].get(c, 0) / m) > most:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    stack.append((self.next[a][c], self.next[b][c]))
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the subtree ``b`` to state ``a``."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.ends[a] += self.ends[b]
            for c, n in self.through[b].items():
                self.through[a][c] = self.through[a].get(c, 0) + n
                if c in self.next[a]:
                    stack.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]


@dataclass(frozen=True)
class Automaton:
    """Transition tables; state 0 is the start, the last state refuses everything."""

    next: np.ndarray  # (states, symbols) int32
    cost: np.ndarray  # (states, symbols) natural logarithm of the probability
    end: np.ndarray  # (states,)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Mean log probability of a character (and the end) of each text; -inf if it is refused."""
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        return self.scores_at(codes("".join(texts)), np.concatenate([[0], ends])[:-1], ends)

    def scores_at(self, read: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """:meth:`scores` of places in a text's :func:`codes`; all places are read in step, one sign at a time."""
        lengths = end - start
        rows = np.argsort(-lengths, kind="stable")
        # places that are still read, by falling length, are at the front
        left = -lengths[rows]
        state, total = np.zeros(len(start), dtype=np.int32), np.zeros(len(start))
        refuse = len(self.end) - 1
        for k in range(int(lengths.max(initial=0))):
            n = int(np.searchsorted(left, -k, "left"))
            rows, left = rows[:n], left[:n]
            if not n:
                break
            symbol = read[start[rows] + k]
            now = state[rows]
            total[rows] += self.cost[now, symbol]
            state[rows] = now = self.next[now, symbol]
            # what is refused stays so
            if k % 8 == 7:
                rows, left = rows[now != refuse], left[now != refuse]
        return (total + self.end[state]) / (lengths + 1)


_OTHER = len(ALPHABET)
_CODES = np.array([ALPHABET.find(chr(b).translate(CLASSES)) % (_OTHER + 1) for b in range(256)], dtype=np.int8)


def codes(text: str) -> np.ndarray:
    """The symbol an automaton reads for every code point of a text."""
    return _CODES[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]


def infer(examples: Iterable[str], alpha: float = 0.05) -> Automaton:
    """The automaton of some examples, read as classes of characters; of none, one that refuses everything."""
    tree = _Tree(e.translate(CLASSES) for e in examples)
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    kept = [0]
    fringe = deque((0, c) for c in sorted(tree.next[0]))
    while fringe:
        parent, c = fringe.popleft()
        state = tree.next[parent][c]
        if state in kept:
            continue
        same = next((k for k in kept if tree.alike(k, state, bound)), None)
        if same is None:
            kept.append(state)
            fringe.extend((state, d) for d in sorted(tree.next[state]))
            continue
        tree.next[parent][c] = same
        known = [len(tree.next[k]) for k in kept]
        tree.fold(same, state)
        fringe.extend(
            (k, d) for k, n in zip(kept, known, strict=True) for d in list(tree.next[k])[n:]
        )
    place = {s: k for k, s in enumerate(kept)}
    refuse = len(kept)
    shape = (refuse + 1, len(ALPHABET) + 1)
    following, cost = np.full(shape, refuse, dtype=np.int32), np.full(shape, -np.inf)
    end = np.full(refuse + 1, -np.inf)
    for s, k in place.items():
        n = tree.count(s)
        if n and tree.ends[s]:
            end[k] = math.log(tree.ends[s] / n)
        for c, m in tree.through[s].items():
            if c in ALPHABET:
                following[k, ALPHABET.index(c)] = place[tree.next[s][c]]
                cost[k, ALPHABET.index(c)] = math.log(m / n)
    return Automaton(following, cost, end)
