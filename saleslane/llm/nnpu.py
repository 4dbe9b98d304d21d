"""Non-negative positive-unlabelled learning of a linear model, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least_share: float = 0.25) -> float:
    """The share of positives among the unlabelled, estimated from 0/1 features alone.

    No region can hold fewer unlabelled rows than the positives' part of it, so the share is at most
    U(region) / P(region) for any region, and equal to it where only positives are. Features, and
    their absence, are the regions; small ones, whose ratio is noisy, are left out.
    """
    if not len(positive) or not len(unlabelled):
        return 0.99
    ratios = [1.0]
    for p, u in ((positive, unlabelled), (1 - positive, 1 - unlabelled)):
        share_p = p.mean(axis=0, dtype=np.float64)
        share_u = u.mean(axis=0, dtype=np.float64)
        ratio = share_u / np.maximum(share_p, 1e-9)
        ratios.append(float(ratio[share_p >= least_share].min(initial=1.0)))
    return float(np.clip(min(ratios), 0.01, 0.99))


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def decision(self, features: np.ndarray) -> np.ndarray:
        return features.astype(np.float32) @ self.weights + self.bias


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def refined_prior(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 2, **how
) -> float:
    """The same bound for regions that a model has found: what it scores above most positives.

    A model learns from one half of the positives, and the other half sets the regions: above its
    first, second and third quartile. Both halves take turns, and the middle of the bounds is taken. The
    model itself may start from a ``prior`` that is too low, as only its order of the rows counts.
    """
    halves = positive[::2], positive[1::2]
    if not len(halves[1]):
        return prior
    for _ in range(steps):
        bounds = []
        for learned, other in (halves, halves[::-1]):
            model = train(learned, unlabelled, prior, **how)
            g_p, g_u = model.decision(other), model.decision(unlabelled)
            for edge in np.quantile(g_p, (0.25, 0.5, 0.75)):
                share_p, share_u = ((g > edge).mean() + (g == edge).mean() / 2 for g in (g_p, g_u))
                bounds.append(share_u / max(share_p, 1e-9))
        prior = float(np.clip(np.median(bounds), 0.01, 0.99))
    return prior


def _logistic(g_p: np.ndarray, g_u: np.ndarray, prior: float) -> tuple:
    """Risk on negatives, and slopes: of positives as such, of positives and unlabelled as negatives."""
    risk = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
    return risk, -sigmoid(-g_p), sigmoid(g_p), sigmoid(g_u)


def _sigmoid(g_p: np.ndarray, g_u: np.ndarray, prior: float) -> tuple:
    at_p, at_u = sigmoid(g_p), sigmoid(g_u)
    slope_p = at_p * (1 - at_p)
    return at_u.mean() - prior * at_p.mean(), -slope_p, slope_p, at_u * (1 - at_u)


LOSSES = {"logistic": _logistic, "sigmoid": _sigmoid}


def train(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    loss: str = "logistic",
    rounds: int = 500,
    rate: float = 0.05,
    decay: float = 1e-6,
) -> Linear:
    """Minimise the non-negative risk with loss l(g): log(1 + exp(-g)), or sigmoid(-g).

    The risk is prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)]). Where the second part, the
    estimated risk on negatives, turns negative, the step goes up its gradient instead, which
    undoes the overfitting that made it negative. Adam over all rows: the same rows in the same order
    give the same model. The logistic loss takes positives that are few; the sigmoid loss is bounded,
    so that no row can outweigh others where positives are most.
    """
    width = positive.shape[1] if len(positive) else unlabelled.shape[1]
    theta = np.zeros(width + 1, np.float32)
    if not len(positive) or not len(unlabelled):
        return Linear(theta[:-1], 0.0)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    p, u = positive.astype(np.float32), unlabelled.astype(np.float32)
    for t in range(1, rounds + 1):
        g_p, g_u = p @ theta[:-1] + theta[-1], u @ theta[:-1] + theta[-1]
        negative_risk, as_positive, p_as_negative, u_as_negative = LOSSES[loss](g_p, g_u, prior)
        grad_negative = _gradient(u, u_as_negative) - prior * _gradient(p, p_as_negative)
        grad_positive = prior * _gradient(p, as_positive)
        grad = grad_positive + grad_negative if negative_risk >= 0 else -grad_negative
        grad[:-1] += decay * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Linear(theta[:-1], float(theta[-1]))


def _gradient(rows: np.ndarray, slope: np.ndarray) -> np.ndarray:
    return np.append(rows.T @ slope, slope.sum()) / len(rows)
