"""A linear classifier learnt from positive and unlabelled examples, in numpy.

The risk over unlabelled text counts all of it as negative and is corrected by the class
prior for the positives hidden in it; where the correction turns the estimate below zero,
the step goes against it, so that the fit does not run away (non-negative risk).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import numpy as np

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = range(4, 9)


def features(text: str) -> Counter:
    """Counts of words and, marked by a hyphen, of the beginnings of longer words."""
    words = Counter(WORD.findall(text.lower()))
    found = Counter(words)
    for word, n in words.items():
        for k in PREFIXES:
            if len(word) <= k:
                break
            found[word[:k] + "-"] += n
    return found


def counted(text: str) -> tuple[Counter, int]:
    """Features and number of words."""
    counts = features(text)
    return counts, sum(n for f, n in counts.items() if f[-1] != "-")


def weight(n, total):
    """Of a feature that n of a text's words have."""
    return np.sqrt(np.minimum(n / np.maximum(total, 1), 0.05)) * np.log1p(n)


class Rows:
    """Sparse rows over a vocabulary."""

    def __init__(self, counted: Iterable[tuple[dict, int]], vocabulary: dict[str, int]):
        place, number, total = [], [], []
        for counts, words in counted:
            known = [f for f in counts if f in vocabulary]
            place.append(np.array([vocabulary[f] for f in known], dtype=np.int32))
            number.append(np.array([counts[f] for f in known], dtype=np.int32))
            total.append(words)
        size = [len(p) for p in place]
        self.row = np.repeat(np.arange(len(size), dtype=np.int32), size)
        self.place = np.concatenate(place)
        self.value = weight(np.concatenate(number), np.repeat(np.array(total), size))
        self.n = len(size)

    def scores(self, w: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.row, self.value * w[self.place], self.n)

    def slope(self, each: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.place, self.value * each[self.row], n)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit(positive: Rows, unlabelled: Rows, n: int, prior: float, steps=300, rate=0.05, decay=1e-4):
    """Weights and bias of the least non-negative risk under logistic loss."""
    w, bias = np.zeros(n), np.log(prior / (1 - prior))
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    log_loss = lambda x: np.logaddexp(0, x).mean()
    for t in range(1, steps + 1):
        p, u = positive.scores(w, bias), unlabelled.scores(w, bias)
        # Gradients of the mean losses by score.
        p_up = (sigmoid(p) - 1) / positive.n
        p_down, u_down = sigmoid(p) / positive.n, sigmoid(u) / unlabelled.n
        negative = log_loss(u) - prior * log_loss(p)
        if negative >= 0:
            on_p, on_u = prior * (p_up - p_down), u_down
        else:
            on_p, on_u = prior * p_down, -u_down
        slope = positive.slope(on_p, n) + unlabelled.slope(on_u, n) + decay * w
        slope = np.r_[slope, on_p.sum() + on_u.sum()]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = rate * first / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def train(positive: list[str], unlabelled: list[str], prior: float, least=4, most=50_000, **options):
    """({feature: weight}, bias), of features that at least ``least`` of the texts have."""
    # The counts of one text at a time are held, so they are made twice.
    seen: Counter = Counter()
    for text in positive + unlabelled:
        seen.update(features(text).keys())
    chosen = sorted((f for f, k in seen.items() if k >= least), key=lambda f: (-seen[f], f))[:most]
    vocabulary = {f: k for k, f in enumerate(chosen)}
    p, u = (Rows(map(counted, texts), vocabulary) for texts in (positive, unlabelled))
    w, bias = fit(p, u, len(chosen), prior, **options)
    return dict(zip(chosen, w)), bias
