"""A small text network in numpy: pooled token vectors, one hidden layer, softmax.

The parameters are one flat vector, so that they can be averaged, stored and sent
as an array. Rows come as lists of token slots (hashed ids).
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

import numpy as np


@dataclass(frozen=True)
class Config:
    """Settings of a network and its training; the fixed values of the small-data default
    are those of the run log: 4 epochs, batches of 20, a report every 100 batches."""

    slots: int = 4096
    width: int = 16
    hidden: int = 16
    classes: int = 2
    dropout: float = 0.1
    rate: float = 1e-3
    decay: float = 5e-4
    milestones: tuple[int, ...] = ()
    gamma: float = 0.1
    epochs: int = 4
    batch: int = 20
    report_every: int = 100
    validate_from: int = 0
    shards: int = 8
    rounds: int = 1
    seed: int = 123

    def facts(self) -> dict:
        return asdict(self)

    @property
    def shapes(self) -> list[tuple[int, ...]]:
        return [(self.slots, self.width), (self.width, self.hidden), (self.hidden,), (self.hidden, self.classes), (self.classes,)]

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.shapes)

    def rate_at(self, epoch: int) -> float:
        """The learning rate of an epoch (from 0): it falls at each milestone passed."""
        return self.rate * self.gamma ** sum(epoch >= m for m in self.milestones)


def start(config: Config) -> np.ndarray:
    """Parameters, first and second moments of a new run, one after the other."""
    draw = np.random.default_rng(config.seed)
    parts = [draw.normal(0, 1 / np.sqrt(s[0] if i else s[-1]), s).ravel() if len(s) > 1 else np.zeros(s) for i, s in enumerate(config.shapes)]
    return np.concatenate([*parts, np.zeros(2 * config.size)])


def unpack(flat: np.ndarray, config: Config) -> list[np.ndarray]:
    out, at = [], 0
    for shape in config.shapes:
        n = int(np.prod(shape))
        out.append(flat[at : at + n].reshape(shape))
        at += n
    return out


def forward(params: list[np.ndarray], slots: np.ndarray, edges: np.ndarray, mask: np.ndarray | None = None):
    """(logits, what the gradient needs) of texts; text ``i`` has ``slots[edges[i]:edges[i+1]]``. A text
    without tokens has the zero vector."""
    vectors, w1, b1, w2, b2 = params
    sizes = np.diff(edges)
    of = np.repeat(np.arange(len(sizes)), sizes)
    pooled = np.zeros((len(sizes), vectors.shape[1]))
    held = sizes > 0
    if len(slots):
        pooled[held] = np.add.reduceat(vectors[slots], edges[:-1][held], axis=0) / sizes[held, None]
    hidden = np.tanh(pooled @ w1 + b1)
    passed = hidden if mask is None else hidden * mask
    return passed @ w2 + b2, (pooled, hidden, passed, of, sizes)


def losses_of(logits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    top = logits.max(axis=1, keepdims=True)
    return (top[:, 0] + np.log(np.exp(logits - top).sum(axis=1))) - logits[np.arange(len(labels)), labels]


def gradient(params, slots, edges, labels, mask=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logits, loss of each row, gradient of their mean as a flat vector)."""
    vectors, w1, _, w2, _ = params
    logits, (pooled, hidden, passed, of, sizes) = forward(params, slots, edges, mask)
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    error = odds / odds.sum(axis=1, keepdims=True)
    error[np.arange(len(labels)), labels] -= 1
    error /= len(labels)
    back = error @ w2.T
    back = (back if mask is None else back * mask) * (1 - hidden**2)
    # counts with weights add in the order of the slots, as np.add.at does, and take a fraction of its time
    by_row = back @ w1.T / np.maximum(sizes, 1)[:, None]
    to_vectors = np.stack([np.bincount(slots, w[of], len(vectors)) for w in by_row.T], axis=1)
    parts = [to_vectors, pooled.T @ back, back.sum(axis=0), passed.T @ error, error.sum(axis=0)]
    return logits, losses_of(logits, labels), np.concatenate([p.ravel() for p in parts])


def dropout_mask(config: Config, epoch: int, batch_id: int, n: int) -> np.ndarray | None:
    """The same for a batch wherever and however often it runs."""
    if not config.dropout:
        return None
    draw = np.random.default_rng([config.seed, epoch, batch_id])
    return (draw.random((n, config.hidden)) >= config.dropout) / (1 - config.dropout)


def step(state: np.ndarray, config: Config, epoch: int, done: int, batch_id: int, slots, edges, labels):
    """One AdamW step on a batch, in place, after ``done`` earlier ones: (loss, predictions)."""
    n = config.size
    weights, first, second = state[:n], state[n : 2 * n], state[2 * n :]
    mask = dropout_mask(config, epoch, batch_id, len(labels))
    logits, losses, slope = gradient(unpack(weights, config), slots, edges, labels, mask)
    first *= 0.9
    first += 0.1 * slope
    second *= 0.999
    second += 0.001 * slope**2
    rate = config.rate_at(epoch)
    weights *= 1 - rate * config.decay
    weights -= rate * (first / (1 - 0.9 ** (done + 1))) / (np.sqrt(second / (1 - 0.999 ** (done + 1))) + 1e-8)
    return float(losses.mean()), logits.argmax(axis=1)
