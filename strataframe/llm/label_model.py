"""Weak supervision: reliabilities of voting rules by expectation-maximisation.

Votes are +1, -1 or 0 (abstain).  The model is the usual one of independent
labelers given the hidden class: labeler j votes +1, 0 or -1 with its own three
probabilities in either class.  It is fitted on counts of vote patterns, a table
of at most 3^rules rows however many items voted, so all items take part.
"""

from __future__ import annotations

import numpy as np


class LabelModel:
    """``fit`` on patterns and counts, then ``posterior`` of any patterns."""

    def __init__(self, labelers: int, prior: float = 0.5, rounds: int = 200, smoothing: float = 1.0, fixed_prior: bool = False, trust: dict[int, float] | None = None):
        self.labelers, self.prior, self.rounds, self.smoothing, self.fixed_prior = labelers, prior, rounds, smoothing, fixed_prior
        # start: a labeler abstains on half of all items and is right in four of
        # five of its votes; one in ``trust`` is right that often, which isn't
        # estimated anew
        self.trusted = sorted(trust or {})
        right = np.array([(trust or {}).get(j, 0.8) for j in range(labelers)]) / 2
        half = np.full(labelers, 0.5)
        # class (0, 1) x labeler x vote (-1, 0, +1)
        self.rates = np.stack([np.stack([right, half, 0.5 - right], axis=1), np.stack([0.5 - right, half, right], axis=1)])

    def fit(self, votes: np.ndarray, counts: np.ndarray, sure: np.ndarray | None = None) -> LabelModel:
        """``votes``: patterns x labelers; ``counts``: items of each pattern;
        ``sure``: patterns whose items are known to be of class 1."""
        votes = np.asarray(votes, dtype=np.int64).reshape(-1, self.labelers)
        counts = np.asarray(counts, dtype=np.float64)
        if not counts.sum():
            return self
        one_hot = np.eye(3)[votes + 1]
        base = self.rates.copy()
        for _ in range(self.rounds):
            good = self.posterior(votes) if sure is None else np.where(sure, 1.0, self.posterior(votes))
            weight = np.stack([(1 - good) * counts, good * counts])
            seen = np.einsum("cp,pjv->cjv", weight, one_hot)
            rates = (seen + self.smoothing * base) / (weight.sum(axis=1)[:, None, None] + self.smoothing)
            rates[:, self.trusted] = base[:, self.trusted]
            prior = self.prior if self.fixed_prior else float(np.clip(weight[1].sum() / counts.sum(), 1e-3, 1 - 1e-3))
            moved = max(np.abs(rates - self.rates).max(), abs(prior - self.prior))
            self.rates, self.prior = rates, prior
            if moved < 1e-7:
                break
        return self

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each pattern."""
        votes = np.asarray(votes, dtype=np.int64).reshape(-1, self.labelers)
        log = np.log(self.rates)
        j = np.arange(self.labelers)
        odds = (log[1][j, votes + 1] - log[0][j, votes + 1]).sum(axis=1) + np.log(self.prior) - np.log1p(-self.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Of each labeler: the share of its votes that the model holds right."""
        share = np.array([1 - self.prior, self.prior])[:, None]
        right = share[0] * self.rates[0, :, 0] + share[1] * self.rates[1, :, 2]
        wrong = share[0] * self.rates[0, :, 2] + share[1] * self.rates[1, :, 0]
        return right / (right + wrong)
