"""Log-bilinear language model over a bounded set of word classes, in numpy.

The two classes before a token predict a vector, ``h = R[a] C1 + R[b] C2``, and
a class scores ``h . Q[w] + bias[w]``. Training is noise-contrastive: tokens
are told from classes drawn by their frequency. As the score is a sum of a term
of the first and a term of the second class, the normaliser of every pair of
context classes comes from one product of two matrices of exponentials.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Classes before all words: words of no class of their own, and the end of a text.
RARE, END = 0, 1
#: Noise classes drawn for each batch, and tokens of a batch.
NOISE, BATCH = 64, 1024
RATE = 0.1
#: Bound of either term of a score, so that no exponential leaves single precision.
CLIP = 25.0


@dataclass
class Parameters:
    """Parameters and their squared-gradient sums, as views of one flat array."""

    classes: int
    width: int
    flat: np.ndarray

    @staticmethod
    def count(classes: int, width: int) -> int:
        return 2 * (classes * (2 * width + 1) + 2 * width * width)

    @staticmethod
    def start(frequency: np.ndarray, width: int, seed: int = 11) -> Parameters:
        """Small random vectors; the bias alone gives every class its frequency."""
        classes, random = len(frequency), np.random.default_rng(seed)
        out = Parameters(classes, width, np.zeros(Parameters.count(classes, width), np.float32))
        words, targets, bias, first, second = out.parts()[0]
        words[:] = random.normal(0, 0.1, words.shape)
        targets[:] = random.normal(0, 0.1, targets.shape)
        bias[:] = np.log(frequency)
        first[:], second[:] = 0.5 * np.eye(width), np.eye(width)
        return out

    def parts(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(context vectors, target vectors, bias, first and second context matrix), and their sums of squares."""
        v, d = self.classes, self.width
        shapes = [(v, d), (v, d), (v,), (d, d), (d, d)]
        views, at = [], 0
        for shape in shapes + shapes:
            size = int(np.prod(shape))
            views.append(self.flat[at : at + size].reshape(shape))
            at += size
        return views[:5], views[5:]


def contexts(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The second and the first class before each token of concatenated texts that all close with ``END``."""
    before = np.empty_like(ids)
    before[:1], before[1:] = END, ids[:-1]
    earlier = np.empty_like(ids)
    earlier[:2], earlier[2:] = END, ids[:-2]
    starts = np.cumsum(lengths) - lengths
    earlier[starts] = END  # the text before it does not reach into a text
    return earlier, before


def _row_sums(index: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """Add each row to the row of ``out`` that ``index`` names."""
    order = np.argsort(index, kind="stable")
    kept, first = np.unique(index[order], return_index=True)
    out[kept] += np.add.reduceat(rows[order], first, axis=0)


def train(model: Parameters, ids: np.ndarray, lengths: np.ndarray, frequency: np.ndarray, seed: int) -> None:
    """One pass over the tokens of some texts in random order, changing ``model`` in place."""
    (words, targets, bias, first, second), sums = model.parts()
    earlier, before = contexts(ids, lengths)
    random = np.random.default_rng(seed)
    order = random.permutation(len(ids))
    steps = np.cumsum(frequency)
    log_noise = np.log(NOISE * frequency).astype(np.float32)
    for at in range(0, len(ids), BATCH):
        some = order[at : at + BATCH]
        a, b, w = earlier[some], before[some], ids[some]
        x = np.minimum(np.searchsorted(steps, random.random(NOISE) * steps[-1], side="right"), model.classes - 1)
        va, vb, qw, qx = words[a], words[b], targets[w], targets[x]
        h = va @ first + vb @ second
        real = 1.0 / (1.0 + np.exp(np.clip(np.einsum("ij,ij->i", h, qw) + bias[w] - log_noise[w], -30, 30)))
        noise = -1.0 / (1.0 + np.exp(-np.clip(h @ qx.T + bias[x] - log_noise[x], -30, 30)))
        back = real[:, None] * qw + noise @ qx
        changes = [np.zeros_like(words), np.zeros_like(targets), np.zeros_like(bias), va.T @ back, vb.T @ back]
        _row_sums(np.concatenate([a, b]), np.concatenate([back @ first.T, back @ second.T]), changes[0])
        _row_sums(np.concatenate([w, x]), np.concatenate([real[:, None] * h, noise.T @ h]), changes[1])
        changes[2] += np.bincount(w, real, model.classes) + np.bincount(x, noise.sum(axis=0), model.classes)
        for value, total, change in zip((words, targets, bias, first, second), sums, changes, strict=True):
            change /= len(some)
            total += change * change
            value += RATE * change / (np.sqrt(total) + 1e-6)


class Scorer:
    """Normalised log-probabilities: tables over pairs of classes, built once."""

    def __init__(self, model: Parameters):
        words, targets, bias, first, second = model.parts()[0]
        self.near = np.clip((words @ second) @ targets.T, -CLIP, CLIP)
        self.far = np.clip((words @ first) @ targets.T, -CLIP, CLIP)
        self.bias = bias - bias.max()
        near, far = self.near.max(axis=1), self.far.max(axis=1)
        products = np.exp(self.far - far[:, None] + self.bias) @ np.exp(self.near - near[:, None]).T
        self.normaliser = np.log(np.maximum(products, np.float32(1e-37))) + far[:, None] + near
        self.far += self.bias

    def log_probabilities(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Natural log-probability of the class of each token, given the two before it."""
        earlier, before = contexts(ids, lengths)
        return self.far[earlier, ids] + self.near[before, ids] - self.normaliser[earlier, before]
