"""Weak supervision: labellers vote for, against or abstain; their accuracies are estimated.

Given the true class, each labeller votes independently of the others. How often
it votes each way in each class, and how common the classes are, are found by
expectation-maximisation. Rows with the same votes count as one, so however many
rows vote, the estimation sees at most 3 ** labellers patterns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FOR, AGAINST, ABSTAIN = 1, -1, 0
ROUNDS = 200
# Votes seen of each labeller before any data: it is more often right than wrong.
PRIOR_RIGHT, PRIOR_WRONG, PRIOR_ABSTAIN = 4.0, 1.0, 2.0


@dataclass
class Votes:
    """Estimated chances: of the class "for", and of each vote given the class."""

    share: float
    # [class against/for, labeller, vote against/abstain/for]
    chance: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of "for" for rows of votes; abstentions say nothing."""
        odds = np.log(self.share) - np.log1p(-self.share)
        labellers = np.arange(patterns.shape[1])
        logs = np.log(self.chance[1] / self.chance[0])
        voted = np.where(patterns == ABSTAIN, 0.0, logs[labellers, patterns + 1])
        return 1 / (1 + np.exp(-np.clip(odds + voted.sum(axis=1), -500, 500)))

    def accuracy(self) -> np.ndarray:
        """Of each labeller, how often a vote is right."""
        right = self.share * self.chance[1, :, 2] + (1 - self.share) * self.chance[0, :, 0]
        wrong = self.share * self.chance[1, :, 0] + (1 - self.share) * self.chance[0, :, 2]
        return right / (right + wrong)


def estimate(
    patterns: np.ndarray, counts: np.ndarray, share: float, doubt: float = 0.25
) -> Votes:
    """Expectation-maximisation over distinct vote ``patterns`` seen ``counts`` times.

    It starts from what the votes against say: none leaves a row "for", each
    multiplies its chance by ``doubt``; rows that nobody votes for or against
    have chance ``share``. The prior, by which labellers are better than chance,
    weighs as much as a hundredth of the rows, so that labellers that rarely
    vote keep it. Without rows the prior is the result.
    """
    patterns = np.asarray(patterns, int)
    counts = np.asarray(counts, float)
    labellers = patterns.shape[1]
    total = max(1.0, counts.sum())
    weight = max(1.0, total / 100) / (PRIOR_RIGHT + PRIOR_WRONG + PRIOR_ABSTAIN)
    good = np.array([PRIOR_WRONG, PRIOR_ABSTAIN, PRIOR_RIGHT])
    prior = weight * np.stack([np.tile(good[::-1], (labellers, 1)), np.tile(good, (labellers, 1))])
    cast = np.stack([patterns == v for v in (AGAINST, ABSTAIN, FOR)], axis=2)
    against = (patterns == AGAINST).sum(axis=1)
    chance_for = np.where((patterns != ABSTAIN).any(axis=1), doubt ** against, share)
    result = None
    for _ in range(ROUNDS):
        of_for = chance_for * counts
        seen = prior + np.stack(
            [np.tensordot(counts - of_for, cast, 1), np.tensordot(of_for, cast, 1)]
        )
        chance = seen / seen.sum(axis=2, keepdims=True)
        now = (of_for.sum() + share * weight) / (counts.sum() + weight)
        result = Votes(float(np.clip(now, 1e-9, 1 - 1e-9)), chance)
        before, chance_for = chance_for, result.posterior(patterns)
        if np.allclose(before, chance_for, 0, 1e-10):
            break
    return result
