"""A linear-chain conditional random field with two labels, in numpy, over many sequences at once.

Sequences lie one after another in one feature matrix; `lengths` tells where each ends. A position's
score for label 1 is `features @ weights`, for label 0 it is 0; `steps[i, j]` scores label j after i.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    weights: np.ndarray
    steps: np.ndarray  # 2 x 2

    def _walk(self, lengths: np.ndarray):
        """Positions of the t-th element of all sequences that have one, and which sequences those are."""
        order = np.argsort(-lengths, kind="stable")
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
        longest_first = lengths[order]
        for t in range(int(longest_first[0]) if len(order) else 0):
            alive = int(np.searchsorted(-longest_first, -t, "left"))
            yield t, alive, starts[:alive] + t

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 2))
        out[:, 1] = features @ self.weights
        return out

    def forward_backward(self, features: np.ndarray, lengths: np.ndarray):
        """Log partition per sequence (longest first), log forward and backward scores per position."""
        emit = self.emissions(features)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        places = [(alive, at) for _, alive, at in self._walk(lengths)]
        for t, (alive, at) in enumerate(places):
            if t == 0:
                ahead[at] = emit[at]
            else:
                reach = ahead[at - 1][:, :, None] + self.steps
                ahead[at] = np.logaddexp(reach[:, 0], reach[:, 1]) + emit[at]
        for alive, at in reversed(places[1:]):
            reach = (behind[at] + emit[at])[:, None, :] + self.steps
            behind[at - 1] = np.logaddexp(reach[:, :, 0], reach[:, :, 1])
        return emit, ahead, behind, places

    def marginals(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of label 1 at each position."""
        _, ahead, behind, _ = self.forward_backward(features, lengths)
        both = ahead + behind
        return np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1]))

    def viterbi(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The likeliest labels; of equally likely ones, those with 0 at the later position."""
        emit = self.emissions(features)
        best, back = emit.copy(), np.zeros(emit.shape, np.int8)
        places = [at for _, _, at in self._walk(lengths)]
        for at in places[1:]:
            reach = best[at - 1][:, :, None] + self.steps
            back[at] = reach.argmax(1)
            best[at] = reach.max(1) + emit[at]
        labels = np.zeros(len(emit), np.int8)
        ends = np.cumsum(lengths)[lengths > 0] - 1
        labels[ends] = best[ends].argmax(1)
        for at in reversed(places[1:]):
            labels[at - 1] = back[at, labels[at]]
        return labels


def fit(features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, penalty: float = 1.0, rounds: int = 150, rate: float = 0.1) -> Chain:
    """Maximum likelihood with a squared penalty, by Adam over all sequences (no randomness)."""
    chain = Chain(np.zeros(features.shape[1]), np.zeros((2, 2)))
    n = max(1, len(lengths))
    if not len(features):
        return chain
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    follows = np.ones(len(features), bool)
    follows[starts[lengths > 0]] = False
    after = np.flatnonzero(follows)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[after - 1], labels[after]), 1)
    m = [np.zeros_like(chain.weights), np.zeros((2, 2))]
    v = [np.zeros_like(chain.weights), np.zeros((2, 2))]
    for k in range(1, rounds + 1):
        emit, ahead, behind, _ = chain.forward_backward(features, lengths)
        total = np.logaddexp(*(ahead + behind).T)
        p = np.exp((ahead + behind)[:, 1] - total)
        pair = ahead[after - 1][:, :, None] + chain.steps + (emit + behind)[after][:, None, :] - total[after][:, None, None]
        gradients = [
            (features.T @ (labels - p) - penalty * chain.weights) / n,
            (seen - np.exp(pair).sum(0) - penalty * chain.steps) / n,
        ]
        for i, (held, g) in enumerate(zip((chain.weights, chain.steps), gradients)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            held += rate * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.999**k)) + 1e-8)
    return chain
