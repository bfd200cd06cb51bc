"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are sequences of rows of a matrix (one row per distinct word), padded at the end. The network
gives one logit per sequence; ``gradients`` is its derivative by all weights and by the input rows.
"""

from __future__ import annotations

import numpy as np

Weights = dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def initial(inputs: int, hidden: int, attention: int, seed: int = 5) -> Weights:
    random = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    weights: Weights = {}
    for side in ("f", "b"):
        weights |= {f"x{side}": normal(inputs, 3 * hidden), f"h{side}": normal(hidden, 3 * hidden)}
        weights[f"c{side}"] = np.zeros(3 * hidden, np.float32)
    weights |= {"a": normal(2 * hidden, attention), "ac": np.zeros(attention, np.float32), "av": normal(attention)}
    return weights | {"o": normal(2 * hidden), "oc": np.zeros(1, np.float32)}


def _run(projected: np.ndarray, index: np.ndarray, lengths: np.ndarray, recurrent: np.ndarray, backward: bool, keep: bool):
    """States after each step, and what the gradient needs."""
    count, steps = index.shape
    hidden = recurrent.shape[0]
    state = np.zeros((count, hidden), np.float32)
    states = np.empty((steps, count, hidden), np.float32)
    kept = []
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        x = projected[index[:, t]]
        h = state @ recurrent
        gates = sigmoid(x[:, : 2 * hidden] + h[:, : 2 * hidden])
        update, reset = gates[:, :hidden], gates[:, hidden:]
        new = np.tanh(x[:, 2 * hidden :] + reset * h[:, 2 * hidden :])
        inside = (t < lengths)[:, None]
        following = np.where(inside, new + update * (state - new), state)
        if keep:
            kept.append((t, state, update, reset, new, h[:, 2 * hidden :], inside))
        states[t] = state = following
    return states, kept


def logits(weights: Weights, rows: np.ndarray, index: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """The logit of each sequence; with ``keep`` also what ``gradients`` needs."""
    sides, kept = [], {}
    for side in ("f", "b"):
        projected = rows @ weights[f"x{side}"] + weights[f"c{side}"]
        states, kept[side] = _run(projected, index, lengths, weights[f"h{side}"], side == "b", keep)
        sides.append(states)
    both = np.concatenate(sides, axis=2)
    heads = np.tanh(both @ weights["a"] + weights["ac"])
    inside = np.arange(index.shape[1])[:, None] < lengths
    score = np.where(inside, heads @ weights["av"], -np.inf)
    score = np.exp(score - np.maximum(score.max(axis=0), -1e30))
    share = score / np.maximum(score.sum(axis=0), 1e-30)
    pooled = (share[:, :, None] * both).sum(axis=0)
    out = pooled @ weights["o"] + weights["oc"]
    return (out, (kept, both, heads, share, pooled)) if keep else out


def gradients(weights: Weights, rows: np.ndarray, index: np.ndarray, kept_all, error: np.ndarray) -> tuple[Weights, np.ndarray]:
    """Derivatives of the sum of ``error`` times logit: by the weights, and by the input rows."""
    kept, both, heads, share, pooled = kept_all
    hidden = both.shape[2] // 2
    out: Weights = {"o": pooled.T @ error, "oc": error.sum(keepdims=True)}
    d_pooled = error[:, None] * weights["o"]
    d_both = share[:, :, None] * d_pooled
    d_share = (both * d_pooled).sum(axis=2)
    d_score = share * (d_share - (share * d_share).sum(axis=0))
    out["av"] = (heads * d_score[:, :, None]).sum(axis=(0, 1))
    d_heads = d_score[:, :, None] * weights["av"] * (1 - heads * heads)
    out["a"] = np.einsum("tbi,tbj->ij", both, d_heads)
    out["ac"] = d_heads.sum(axis=(0, 1))
    d_both += d_heads @ weights["a"].T
    d_rows = np.zeros_like(rows)
    for side, part in (("f", slice(0, hidden)), ("b", slice(hidden, 2 * hidden))):
        recurrent = weights[f"h{side}"]
        d_recurrent = np.zeros_like(recurrent)
        d_projected = np.zeros((len(rows), 3 * hidden), np.float32)
        carried = np.zeros((index.shape[0], hidden), np.float32)
        for t, before, update, reset, new, h_new, inside in reversed(kept[side]):
            d = carried + d_both[t, :, part]
            d_in = np.where(inside, d, 0)
            d_new = d_in * (1 - update) * (1 - new * new)
            d_update = d_in * (before - new) * update * (1 - update)
            d_reset = d_new * h_new * reset * (1 - reset)
            d_h = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
            d_recurrent += before.T @ d_h
            np.add.at(d_projected, index[:, t], np.concatenate([d_update, d_reset, d_new], axis=1))
            carried = np.where(inside, d_in * update, d) + d_h @ recurrent.T
        out[f"h{side}"] = d_recurrent
        out[f"x{side}"] = rows.T @ d_projected
        out[f"c{side}"] = d_projected.sum(axis=0)
        d_rows += d_projected @ weights[f"x{side}"].T
    return out, d_rows


class Adam:
    def __init__(self, weights: Weights, rate: float, rates: dict[str, float]):
        self.weights, self.steps = weights, 0
        self.rates = {k: rates.get(k, rate) for k in weights}
        self.mean = {k: np.zeros_like(w) for k, w in weights.items()}
        self.square = {k: np.zeros_like(w) for k, w in weights.items()}

    def step(self, slopes: Weights) -> None:
        self.steps += 1
        for k, slope in slopes.items():
            self.mean[k] = 0.9 * self.mean[k] + 0.1 * slope
            self.square[k] = 0.999 * self.square[k] + 0.001 * slope * slope
            mean, square = self.mean[k] / (1 - 0.9**self.steps), self.square[k] / (1 - 0.999**self.steps)
            self.weights[k] -= (self.rates[k] * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)
