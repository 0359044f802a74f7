"""Toxicity by non-negative positive-unlabelled learning (operator 2).

Confirmed toxic rows are the positives; the unlabelled rows are drawn from all rows, whether or
not somebody looked at them. A linear model on word indicators minimises the
non-negative risk ``p * R+(1) + max(0, R_u(0) - p * R+(0))`` with the logistic loss, so
that its output estimates the probability under the class prior p. When the
bracket falls below zero (the model has begun to tell the training positives from the same
texts among the unlabelled) the step goes the other way, as in the published
algorithm. The prior is the share of toxic rows among the labelled ones of the
training folds.

The fit uses at most ``most_pos`` positive and ``most_unl`` unlabelled rows, the smallest by
a hash of the id; scoring covers every row and whole texts. Only ``text`` is an input.

Defined results: null, empty and blank texts have no features and get the model's
base score; rows with a null ``doc_id`` are scored, never learnt from, and are not held out;
rows that repeat an id are scored each; without any positive row every score is
0; an empty table gives an empty result; labels that are null are ignored;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.llm.common import fold
from newsframe.llm.features import bare_words, bounded_ids, row_sums, sample, scored

MOD, REST, CUT = 4, 2, 0.3
#: Rows of the sample that ``telling`` counts at a time.
STEP = 1024


def fit_nnpu(x: np.ndarray, bounds: np.ndarray, positive: np.ndarray, prior: float, width: int, epochs: int = 12,
             batch: int = 512, rate: float = 0.08, decay: float = 2e-5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias; ``positive`` marks the rows known to be positive."""
    rng = np.random.default_rng(seed)
    w, g2, b, b2 = np.zeros(width), np.full(width, 1e-4), float(np.log(prior / (1 - prior))), 1e-4
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    size = np.diff(bounds)
    steps = max(1, len(unl) // batch)
    for _ in range(max(epochs, 1500 // steps)):
        order = rng.permutation(unl)
        for s in range(steps):
            u = order[s * batch:(s + 1) * batch]
            p = rng.choice(pos, size=min(len(pos), batch), replace=False)
            rows = np.concatenate([p, u])
            n = size[rows]
            ends = np.cumsum(n)
            at = np.arange(int(ends[-1])) + np.repeat(bounds[rows] - (ends - n), n)
            f = x[at]
            z = row_sums(w[f], np.concatenate([[0], ends])) + b
            q = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            loss0 = np.logaddexp(0, z)
            zp, zu = loss0[: len(p)].mean(), loss0[len(p):].mean()
            neg = zu - prior * zp
            # derivative of each row's loss by its z: to 1 (q - 1), to 0 q
            gp = np.concatenate([prior * (q[: len(p)] - 1) / len(p), np.zeros(len(u))])
            gn = np.concatenate([-prior * q[: len(p)] / len(p), q[len(p):] / len(u)])
            g = gp + gn if neg >= 0 else -gn
            grad = np.bincount(f, weights=np.repeat(g, n), minlength=width)
            touched = np.flatnonzero(grad)
            grad = grad[touched] + decay * w[touched]
            g2[touched] += grad * grad
            w[touched] -= rate * grad / np.sqrt(g2[touched])
            gb = g.sum()
            b2 += gb * gb
            b -= rate * gb / np.sqrt(b2)
    return w, b


def telling(x: np.ndarray, bounds: np.ndarray, positive: np.ndarray, width: int, least: float = 14.0) -> tuple[np.ndarray, np.ndarray]:
    """The runs with only the features whose counts among positives and unlabelled have
    a log-likelihood ratio statistic of ``least`` or more."""
    p, u = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
    for i in range(0, len(positive), STEP):  # some rows at a time: numpy widens what it counts
        at = bounds[i:i + STEP + 1]
        row, part = np.repeat(positive[i:i + STEP], np.diff(at)), x[at[0]:at[-1]]
        p += np.bincount(part[row], minlength=width)
        u += np.bincount(part[~row], minlength=width)
    n, m = positive.sum(), (~positive).sum()
    part = n / (n + m)
    with np.errstate(divide="ignore", invalid="ignore"):
        stat = 2 * (np.where(p > 0, p * np.log(p / ((p + u) * part)), 0) + np.where(u > 0, u * np.log(u / ((p + u) * (1 - part))), 0))
    good = stat >= least
    keep = np.empty(len(x), dtype=bool)
    for i in range(0, len(x), 1 << 20):
        keep[i:i + (1 << 20)] = good[x[i:i + (1 << 20)]]
    at = np.flatnonzero(keep)
    return x[at], np.searchsorted(at, bounds)


def toxicity_scores(docs: DataFrame, labels: DataFrame, most_pos: int = 8_000, most_unl: int = 16_000, bits: int = 20,
                    mod: int = MOD, rest: int = REST, cut: float = CUT, keep: list[str] = ()) -> DataFrame:
    """doc_id (or the columns ``keep``), score, held_out and predicted of every row."""
    spark = docs.sparkSession
    featuriser = bare_words(bits)
    lab = labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    lab = lab.filter(fold("doc_id", mod) != rest).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = lab.agg(F.avg("toxic")).first()[0]
    weights, bias = np.zeros(1 << bits), -40.0
    if share:
        known = lab.filter("toxic = 1").select("doc_id")
        pos = bounded_ids(known, most_pos).withColumn("tag", F.lit(1))
        every = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().filter(fold("doc_id", mod) != rest)
        unl = bounded_ids(every, most_unl).withColumn("tag", F.lit(0))  # positives among them, in the share of the prior
        x, bounds, tag = sample(spark, docs, pos.union(unl), featuriser)
        if (tag == 1).any() and (tag == 0).any():
            x, bounds = telling(x, bounds, tag == 1, 1 << bits)
            seen = np.zeros(1 << bits, dtype=bool)
            seen[x] = True
            used, x = np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - np.int32(1))[x]
            w, bias = fit_nnpu(x, bounds, tag == 1, min(max(float(share), 1e-4), 0.9), len(used))
            weights[used] = w
    return scored(docs, featuriser, weights, bias, mod, rest, cut, keep)
