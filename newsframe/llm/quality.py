"""Quality classifier: naive Bayes support vectors (operator 8).

n-gram indicators are scaled by the log ratio of their smoothed relative counts in the
two classes; a linear hinge-loss model is fitted on them by dual coordinate
descent and interpolated with the mean weight, and its margin is mapped to
a probability by a logistic curve fitted on rows that were left out of the descent.

The fit uses at most ``most`` labelled rows of the training folds (the smallest by a hash of the
id); scoring covers every row and whole texts. Only ``text`` is an input.

Defined results: null, empty and blank texts have no features and get the model's base
score; rows with a null ``doc_id`` are scored, never learnt from, and are not held out; rows that
repeat an id are scored each; without labelled rows of both classes every
score is the share of label 1 (1 without any label); an empty table gives an empty
result; null labels and other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.llm.common import fold
from newsframe.llm.features import bounded_ids, row_sums, sample, scored, word_ngrams

MOD, REST, CUT = 5, 0, 0.3


def log_ratio(x: np.ndarray, bounds: np.ndarray, y: np.ndarray, width: int, smooth: float = 1.0) -> np.ndarray:
    row = np.repeat(y, np.diff(bounds))
    p = np.bincount(x[row], minlength=width) + smooth
    q = np.bincount(x[~row], minlength=width) + smooth
    return np.log((p / p.sum()) / (q / q.sum()))


def fit_hinge(x: np.ndarray, bounds: np.ndarray, v: np.ndarray, y: np.ndarray, width: int, c: float, epochs: int = 12, seed: int = 3) -> np.ndarray:
    """Weights of the L2-regularised hinge loss by dual coordinate descent; ``v``: the
    features' values, ``y``: +1 or -1. The last weight is the bias."""
    rng = np.random.default_rng(seed)
    w, alpha = np.zeros(width + 1), np.zeros(len(y))
    square = row_sums(v * v, bounds) + 1
    active = np.arange(len(y))
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(active):
            a, b = bounds[i], bounds[i + 1]
            f, u = x[a:b], v[a:b]
            g = y[i] * (w[f] @ u + w[-1]) - 1
            pg = min(g, 0) if alpha[i] == 0 else max(g, 0) if alpha[i] == c else g
            if pg:
                most = max(most, abs(pg))
                new = min(max(alpha[i] - g / square[i], 0), c)
                step = (new - alpha[i]) * y[i]
                alpha[i] = new
                w[f] += step * u
                w[-1] += step
        if most < 1e-3:
            break
    return w


def logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * margin + b))), with smoothed targets."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        r, s = q - t, q * (1 - q) + 1e-9
        h = np.array([[(s * margin * margin).sum() + 1e-6, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        d = np.linalg.solve(h, [(r * margin).sum(), r.sum()])
        d *= min(1.0, 2.0 / max(np.abs(d).max(), 1e-9))
        a, b = a - d[0], b - d[1]
    return float(a), float(b)


def fit(x, bounds, y, width: int, c: float = 0.1, keep: float = 0.75) -> tuple[np.ndarray, float]:
    """Weights and bias on plain indicators whose logistic is the score."""
    n = np.diff(bounds)
    r = log_ratio(x, bounds, y, width)
    scale = (1 / np.sqrt(np.maximum(n, 1))).astype(np.float32)  # rows of equal length
    part = np.arange(len(y)) % 4 != 3
    if not (y[part].any() and (~y[part]).any() and y[~part].any() and (~y[~part]).any()):
        part[:] = True

    def take(rows):
        m = n[rows]
        ends = np.cumsum(m)
        at = np.arange(int(ends[-1])) + np.repeat(bounds[rows] - (ends - m), m)
        return x[at], np.concatenate([[0], ends]), np.repeat(scale[rows], m)
    rows = np.flatnonzero(part)
    xt, bt, st = take(rows)
    rt = log_ratio(xt, bt, y[rows], width)
    w = fit_hinge(xt, bt, rt.astype(np.float32)[xt] * st, np.where(y[rows], 1.0, -1.0), width, c)
    beta = np.abs(w[:-1]).mean()
    w[:-1] = (1 - keep) * beta + keep * w[:-1]
    held = np.arange(len(y)) if part.all() else np.flatnonzero(~part)
    xh, bh, sh = take(held)
    a, b = logistic(row_sums((rt * w[:-1])[xh] * sh, bh) + w[-1], np.where(y[held], 1, -1))
    return rt * w[:-1] * a, w[-1] * a + b


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = 16_000, bits: int = 20, mod: int = MOD, rest: int = REST,
                   cut: float = CUT) -> DataFrame:
    """doc_id, score, held_out and predicted of every row."""
    spark = docs.sparkSession
    featuriser = word_ngrams(bits)
    lab = labels.filter("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    lab = lab.filter(fold("doc_id", mod) != rest).groupBy("doc_id").agg(F.max("quality").alias("tag"))
    x, bounds, tag = sample(spark, docs, bounded_ids(lab, most), featuriser)
    y = tag > 0
    if y.any() and not y.all():
        weights, bias = fit(x, bounds, y, 1 << bits)
    else:
        weights, bias = np.zeros(1 << bits), -40.0 if len(y) and not y.any() else 40.0
    return scored(docs, featuriser, weights, bias, mod, rest, cut, even=True)
