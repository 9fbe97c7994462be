"""A linear-chain conditional random field in numpy: training by gradient, decoding by Viterbi, both in batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Words, with padding, that are decoded together.
CELLS = 65_536
#: Words of a longer sequence that are scored at a time.
WINDOW = 8_192


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Crf:
    """Weights of features per label (row 0: a feature not seen in training) and of label pairs."""

    labels: list[str]
    index: dict[str, int]
    state: np.ndarray  # feature x label
    step: np.ndarray  # label x label
    first: np.ndarray  # label

    def rows(self, sequence: Sequence[Sequence[str]]) -> np.ndarray:
        """Feature numbers, word x feature; every word has equally many features."""
        get = self.index.get
        return np.array([[get(f, 0) for f in word] for word in sequence], dtype=np.int64)

    def viterbi(self, sequences: Sequence[Sequence[Sequence[str]]]) -> list[list[str]]:
        """The best labels of each sequence; of equally good ones the first in label order."""
        order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: len(sequences[i]))
        out: list[list[str]] = [[] for _ in sequences]
        at = 0
        while at < len(order):
            end = at + 1  # sequences come by length, so the last one of a batch gives its width
            while end < len(order) and (end + 1 - at) * len(sequences[order[end]]) <= CELLS:
                end += 1
            part = order[at:end]
            if len(sequences[part[-1]]) > WINDOW:
                paths = [self._long_path(sequences[i]) for i in part]
            else:
                paths = self._paths(*_padded([self.state[self.rows(sequences[i][:])].sum(axis=1) for i in part]))
            for i, path in zip(part, paths, strict=True):
                out[i] = [self.labels[k] for k in path]
            at = end
        return out

    def _long_path(self, sequence: Sequence[Sequence[str]]) -> list[int]:
        """The best labels of one sequence, scored window by window; only its back pointers are as long as it is."""
        back = np.zeros((len(sequence), len(self.labels)), dtype=np.min_scalar_type(len(self.labels)))
        best = None
        for start in range(0, len(sequence), WINDOW):
            scores = self.state[self.rows(sequence[start : start + WINDOW])].sum(axis=1)
            for t, score in enumerate(scores, start):
                if best is None:
                    best = score + self.first
                    continue
                through = best[:, None] + self.step
                back[t] = through.argmax(axis=0)
                best = through.max(axis=0) + score
        path = [int(best.argmax())]
        for t in range(len(sequence) - 1, 0, -1):
            path.append(int(back[t, path[-1]]))
        return path[::-1]

    def _paths(self, scores: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
        n, size, k = scores.shape
        best = scores[:, 0] + self.first
        back = np.zeros((n, size, k), dtype=np.int32)
        for t in range(1, size):
            through = best[:, :, None] + self.step
            back[:, t] = through.argmax(axis=1)
            best = np.where((t < lengths)[:, None], through.max(axis=1) + scores[:, t], best)
        last = best.argmax(axis=1)
        paths = []
        for row in range(n):
            path = [int(last[row])]
            for t in range(lengths[row] - 1, 0, -1):
                path.append(int(back[row, t, path[-1]]))
            paths.append(path[::-1])
        return paths


def _padded(scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in scores])
    out = np.zeros((len(scores), lengths.max(initial=1), scores[0].shape[1]))
    for row, s in enumerate(scores):
        out[row, : len(s)] = s
    return out, lengths


def train(
    sequences: Sequence[Sequence[Sequence[str]]], tags: Sequence[Sequence[str]], labels: list[str],
    rounds: int = 120, rate: float = 0.3, decay: float = 1e-3,
) -> Crf:
    """Fit by AdaGrad on the penalised log-likelihood of the whole (small) table, a fixed number of rounds."""
    features = sorted({f for s in sequences for word in s for f in word})
    model = Crf(labels, {f: i + 1 for i, f in enumerate(features)}, np.zeros((len(features) + 1, len(labels))),
                np.zeros((len(labels), len(labels))), np.zeros(len(labels)))
    if not sequences:
        return model
    k, n = len(labels), len(sequences)
    lengths = np.array([len(s) for s in sequences])
    size, width = lengths.max(), len(sequences[0][0])
    x = np.zeros((n, size, width), dtype=np.int64)
    y = np.zeros((n, size), dtype=np.int64)
    for row, (s, t) in enumerate(zip(sequences, tags, strict=True)):
        x[row, : len(s)] = model.rows(s)
        y[row, : len(s)] = [labels.index(tag) for tag in t]
    inside = np.arange(size) < lengths[:, None]
    parameters = [model.state, model.step, model.first]
    squares = [np.full_like(p, 1e-8) for p in parameters]
    for _ in range(rounds):
        single, pairs = _expected(model, x, lengths, inside)
        single[np.arange(n)[:, None], np.arange(size), y] -= inside
        gradients = [np.zeros_like(model.state), pairs, single[:, 0].sum(axis=0)]
        for f in range(width):
            np.add.at(gradients[0], x[:, :, f][inside], single[inside])
        both = inside[:, 1:]
        np.subtract.at(gradients[1], (y[:, :-1][both], y[:, 1:][both]), 1)
        for p, g, s in zip(parameters, gradients, squares, strict=True):
            g = g / n + decay * p
            s += g * g
            p -= rate * g / np.sqrt(s)
        model.state[0] = 0
    return model


def _expected(model: Crf, x: np.ndarray, lengths: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of every word, and expected counts of label pairs, by forward and backward sums."""
    scores = model.state[x].sum(axis=2)
    n, size, k = scores.shape
    forward, backward = np.zeros((n, size, k)), np.zeros((n, size, k))
    forward[:, 0] = scores[:, 0] + model.first
    for t in range(1, size):
        forward[:, t] = _log_sum(forward[:, t - 1][:, :, None] + model.step, 1) + scores[:, t]
    for t in range(size - 2, -1, -1):
        through = _log_sum(model.step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where((t + 1 < lengths)[:, None], through, 0)
    total = _log_sum(forward[np.arange(n), lengths - 1], 1)
    single = np.where(inside[:, :, None], np.exp(forward + backward - total[:, None, None]), 0)
    pairs = np.zeros((k, k))
    for t in range(size - 1):
        joint = forward[:, t][:, :, None] + model.step + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
        pairs += np.exp(joint - total[:, None, None])[t + 1 < lengths].sum(axis=0)
    return single, pairs
