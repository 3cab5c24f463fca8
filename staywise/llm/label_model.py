"""A generative model of binary voters: their accuracies, their correlations, and the posterior of the label.

Given the label, the voters' joint probability is log-linear: a weight per voter, and one per correlated pair. With a
dozen voters all vote patterns can be listed, so the normalisation is exact, and the whole table comes in as counts
of patterns: at most 2 ** voters rows, whatever the number of documents. The fit is expectation maximisation;
documents with a known label enter with that label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Parameters of the fit.
ROUNDS = 40
STEPS = 25
PAIRS = 8
LEAST_CORRELATION = 0.05
#: At the start only voters that nearly repeat each other are taken for correlated: two of them could pass for the label.
START_CORRELATION = 0.4
RIDGE = 1e-3


@dataclass
class LabelModel:
    """``posterior`` by vote pattern; ``fires``: P(vote | label) by label and voter; ``pairs``: correlated voters."""

    posterior: np.ndarray
    fires: np.ndarray
    pairs: list[tuple[int, int]]
    prior: float


def _states(voters: int) -> np.ndarray:
    return (np.arange(1 << voters)[:, None] >> np.arange(voters) & 1).astype(float)


def _fit_class(design: np.ndarray, weight: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Maximise the likelihood of one class by Newton steps on its few weights."""
    total = weight.sum()
    if total <= 0:
        return theta
    target = weight @ design / total
    for _ in range(STEPS):
        score = design @ theta
        p = np.exp(score - score.max())
        p /= p.sum()
        mean = p @ design
        slope = target - mean - RIDGE * theta
        if np.abs(slope).max() < 1e-7:
            break
        spread = (design * p[:, None]).T @ design - np.outer(mean, mean) + RIDGE * np.eye(len(theta))
        theta = theta + np.clip(np.linalg.solve(spread, slope), -1.0, 1.0)
    return theta


def _log_likelihood(design: np.ndarray, theta: np.ndarray) -> np.ndarray:
    score = design @ theta
    return score - score.max() - np.log(np.exp(score - score.max()).sum())


def fit(counts: np.ndarray, voters: int, strong: list[int]) -> LabelModel:
    """``counts`` by (pattern, known label 0, known label 1, unknown). ``strong`` voters start as the more accurate ones."""
    states = _states(voters)
    known0, known1, unknown = counts.T.astype(float)
    everyone = counts.sum()
    if everyone == 0:
        return LabelModel(np.zeros(1 << voters), np.zeros((2, voters)), [], 0.0)
    # the start: a pattern with a strong vote is likelier to be of label 1
    posterior = np.where(states[:, strong].any(axis=1), 0.9, 0.02) if strong else np.full(len(states), 0.1)
    guess = (known0 + unknown * (1 - posterior), known1 + unknown * posterior)
    pairs = _correlated(states, guess, START_CORRELATION)
    design, theta = _design(states, pairs)
    for step in range(ROUNDS):
        one, zero = known1 + unknown * posterior, known0 + unknown * (1 - posterior)
        prior = (one.sum() + 1) / (everyone + 2)
        theta = [_fit_class(design, zero, theta[0]), _fit_class(design, one, theta[1])]
        odds = np.log(prior / (1 - prior)) + _log_likelihood(design, theta[1]) - _log_likelihood(design, theta[0])
        before, posterior = posterior, 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if step == ROUNDS // 2:
            pairs = list(dict.fromkeys([*pairs, *_correlated(states, (zero, one), LEAST_CORRELATION)]))[:PAIRS]
            design, theta = _design(states, pairs)
        elif step > ROUNDS // 2 and np.abs(before - posterior).max() < 1e-6:
            break
    fires = np.array([(w @ states + 0.5) / (w.sum() + 1) for w in (zero, one)])
    return LabelModel(posterior, fires, pairs, float(prior))


def _design(states: np.ndarray, pairs: list[tuple[int, int]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """One column per voter and per pair, and weights to start from, by label."""
    both = [states[:, i] * states[:, j] for i, j in pairs]
    design = np.column_stack([states, *both])
    return design, [np.zeros(design.shape[1]), np.zeros(design.shape[1])]


def _correlated(
    states: np.ndarray, by_class: tuple[np.ndarray, np.ndarray], least: float
) -> list[tuple[int, int]]:
    """The pairs of voters that agree more, or less, than the label explains."""
    found: dict[tuple[int, int], float] = {}
    for weight in by_class:
        total = weight.sum()
        if total < 20:
            continue
        mean = weight @ states / total
        spread = (states * weight[:, None]).T @ states / total - np.outer(mean, mean)
        scale = np.sqrt(np.clip(np.diag(spread), 1e-6, None))
        correlation = spread / np.outer(scale, scale)
        for i in range(len(mean)):
            for j in range(i + 1, len(mean)):
                if abs(correlation[i, j]) >= least:
                    found[i, j] = max(found.get((i, j), 0.0), abs(correlation[i, j]))
    return sorted(found, key=lambda p: -found[p])[:PAIRS]
