"""A linear-chain conditional random field over sequences of feature numbers, in numpy."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

#: Sequences: for each place the numbers of its features. Feature 0 is the unknown one.
Sequences = list[list[list[int]]]


def _summed(values: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials over the first of the last two axes."""
    top = values.max(axis=-2, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=-2)) + top.squeeze(-2)


@dataclass(frozen=True)
class Crf:
    """Weights of (feature, label) and of (label, next label); sequences lie between labels 0."""

    emit: np.ndarray
    move: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """(sequences, places, features) to (sequences, places, labels)."""
        return self.emit[rows].sum(axis=2)

    def decode(self, sequences: Sequences) -> tuple[list[np.ndarray], np.ndarray]:
        """The best labels of each sequence, and how far its score is above that of labels 0 alone.

        Sequences of one length are decoded together.
        """
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(sequences)
        gain = np.zeros(len(sequences))
        by_length: dict[int, list[int]] = {}
        for k, s in enumerate(sequences):
            by_length.setdefault(len(s), []).append(k)
        for length, own in by_length.items():
            step = max(1, (1 << 18) // max(length, 1))
            for a in range(0, len(own), step):
                part = own[a : a + step]
                labels, more = self._viterbi(np.array([sequences[k] for k in part]))
                for k, path, g in zip(part, labels, more, strict=True):
                    out[k], gain[k] = path, g
        return out, gain

    def decode_blocks(self, blocks: Iterable[list[list[int]]]) -> tuple[np.ndarray, float]:
        """:meth:`decode` of one long sequence that comes in blocks; the best scores are carried from one to the next."""
        best, none = np.where(np.arange(len(self.move)) == 0, 0.0, -np.inf), 0.0
        backs = []
        for block in blocks:
            scores = self.scores(np.array([block]))[0]
            back = np.empty(scores.shape, dtype=np.int8)
            for t in range(len(block)):
                ways = best[:, None] + self.move
                back[t] = ways.argmax(axis=0)
                best = ways.max(axis=0) + scores[t]
            backs.append(back)
            none += scores[:, 0].sum() + len(block) * self.move[0, 0]
        best = best + self.move[:, 0]
        back = np.concatenate(backs)
        labels = np.zeros(len(back), dtype=np.int64)
        labels[-1] = best.argmax()
        for t in range(len(back) - 1, 0, -1):
            labels[t - 1] = back[t, labels[t]]
        return labels, float(best.max() - none - self.move[0, 0])

    def _viterbi(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scores = self.scores(rows)
        n, length, _ = scores.shape
        best = scores[:, 0] + self.move[0]
        back = np.zeros(scores.shape, dtype=np.int8)
        for t in range(1, length):
            ways = best[:, :, None] + self.move
            back[:, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[:, t]
        best = best + self.move[:, 0]
        labels = np.zeros((n, length), dtype=np.int64)
        labels[:, -1] = best.argmax(axis=1)
        for t in range(length - 1, 0, -1):
            labels[:, t - 1] = back[np.arange(n), t, labels[:, t]]
        none = scores[:, :, 0].sum(axis=1) + (length + 1) * self.move[0, 0]
        return labels, best.max(axis=1) - none


def train(
    sequences: Sequences, labels: list[list[int]], features: int, classes: int, steps: int = 150, decay: float = 1e-3
) -> Crf:
    """Weights of greatest penalised likelihood, by Adam on all sequences at once.

    Every place must have the same number of features. No sequences give weights of 0.
    """
    emit, move = np.zeros((features, classes)), np.zeros((classes, classes))
    if not sequences:
        return Crf(emit, move)
    groups = []
    for length in sorted({len(s) for s in sequences}):
        own = [k for k, s in enumerate(sequences) if len(s) == length]
        groups.append((np.array([sequences[k] for k in own]), np.array([labels[k] for k in own])))
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (emit, move)]
    for step in range(1, steps + 1):
        model = Crf(emit, move)
        slopes = [np.zeros_like(emit), np.zeros_like(move)]
        for rows, truth in groups:
            _add_slopes(model, rows, truth, *slopes)
        for weights, slope, (first, second) in zip((emit, move), slopes, moments, strict=True):
            slope = slope / len(sequences) - decay * weights
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            weights += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Crf(emit, move)


def _add_slopes(model: Crf, rows: np.ndarray, truth: np.ndarray, d_emit: np.ndarray, d_move: np.ndarray) -> None:
    """Observed less expected counts of features and moves, by forward and backward sums."""
    scores = model.scores(rows)
    n, length, classes = scores.shape
    ahead = np.empty_like(scores)
    ahead[:, 0] = scores[:, 0] + model.move[0]
    for t in range(1, length):
        ahead[:, t] = _summed(ahead[:, t - 1, :, None] + model.move) + scores[:, t]
    behind = np.empty_like(scores)
    behind[:, -1] = model.move[:, 0]
    for t in range(length - 2, -1, -1):
        behind[:, t] = _summed((model.move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :]).swapaxes(1, 2))
    total = _summed((ahead[:, -1] + model.move[:, 0])[:, :, None])
    expected = np.exp(ahead + behind - total[:, None])
    rest = np.eye(classes)[truth] - expected
    for f in range(rows.shape[2]):
        np.add.at(d_emit, rows[:, :, f], rest)
    for t in range(1, length):
        both = ahead[:, t - 1, :, None] + model.move + (scores[:, t] + behind[:, t])[:, None, :]
        np.add.at(d_move, (truth[:, t - 1], truth[:, t]), 1)
        d_move -= np.exp(both - total[:, :, None]).sum(axis=0)
    np.add.at(d_move, (0, truth[:, 0]), 1)
    np.add.at(d_move, (truth[:, -1], 0), 1)
    d_move[0] -= expected[:, 0].sum(axis=0)
    d_move[:, 0] -= expected[:, -1].sum(axis=0)
