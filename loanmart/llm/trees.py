"""Trees on binned features, fitted from counts by feature combination and applied as Column expressions.

Training data is a contingency table: one row for each combination of bins that occurs, with the number of positive and
negative cases, counted by Spark over all rows. Its size is bounded by the product of the bin counts, whatever the
data. A fitted model is a Column over the binned features, so scoring stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest product of bin counts.
MOST_CELLS = 1 << 17

Node = tuple  # (value,) or (feature number, largest bin that goes left, left, right)


@dataclass
class Cells:
    x: np.ndarray
    pos: np.ndarray
    neg: np.ndarray


def counted(cases: DataFrame, bins: Mapping[str, int], label: str = "label") -> Cells:
    """Counts of label 1 and 0 by bins; rows with a null label are not counted. ``bins``: feature and number of its bins."""
    size = int(np.prod(list(bins.values())))
    if size > MOST_CELLS:
        raise ValueError(f"{size} combinations of bins; at most {MOST_CELLS}")
    rows = cases.where(F.col(label).isNotNull()).groupBy(*bins).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q")).orderBy(*bins).collect()
    x = np.array([[r[f] for f in bins] for r in rows], dtype=np.int64).reshape(len(rows), len(bins))
    return Cells(x, np.array([r.p for r in rows], dtype=float), np.array([r.q for r in rows], dtype=float))


def _grow(x, g, h, depth: int, choose: Callable[[int], Sequence[int]], leaf: Callable[[float, float], float], least: float) -> Node:
    """Split where the gain in sum(g)^2 / sum(h) is largest."""
    whole_g, whole_h = g.sum(), h.sum()
    best = (1e-9, None, None)
    if depth and len(x) > 1:
        for f in choose(x.shape[1]):
            values = np.unique(x[:, f])
            for v in values[:-1]:
                left = x[:, f] <= v
                hl, hr = h[left].sum(), h[~left].sum()
                if hl < least or hr < least:
                    continue
                gl = g[left].sum()
                gain = gl * gl / (hl + 1e-9) + (whole_g - gl) ** 2 / (hr + 1e-9) - whole_g ** 2 / (whole_h + 1e-9)
                if gain > best[0]:
                    best = (gain, f, int(v))
    _, f, v = best
    if f is None:
        return (leaf(whole_g, whole_h),)
    left = x[:, f] <= v
    return (f, v, *(_grow(x[s], g[s], h[s], depth - 1, choose, leaf, least) for s in (left, ~left)))


def evaluate(node: Node, x: np.ndarray) -> np.ndarray:
    if len(node) == 1:
        return np.full(len(x), node[0])
    f, v, left, right = node
    return np.where(x[:, f] <= v, evaluate(left, x), evaluate(right, x))


def boosted(cells: Cells, rounds: int = 24, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> tuple[float, list[Node]]:
    """Gradient boosting on the logistic loss: start value and trees whose sum is the log odds."""
    n = cells.pos + cells.neg
    if not len(n):
        return -10.0, []
    start = float(np.log((cells.pos.sum() + 0.5) / (cells.neg.sum() + 0.5)))
    z, trees = np.full(len(n), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        tree = _grow(cells.x, cells.pos - n * p, n * p * (1 - p), depth, range, lambda g, h: float(rate * g / (h + ridge)), 1e-3)
        trees.append(tree)
        z = z + evaluate(tree, cells.x)
    return start, trees


def forest(cells: Cells, trees: int = 24, depth: int = 6, seed: int = 11) -> list[Node]:
    """Random forest: each tree on resampled counts, each split among a random half of the features; leaves hold shares."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees if len(cells.pos) else 0):
        pos, neg = rng.poisson(cells.pos).astype(float), rng.poisson(cells.neg).astype(float)
        use = pos + neg > 0
        if not use.any():
            pos, neg, use = cells.pos, cells.neg, np.ones(len(cells.pos), dtype=bool)
        n = (pos + neg)[use]
        share = pos[use].sum() / n.sum()
        pick = lambda k: rng.choice(k, size=(k + 1) // 2, replace=False)
        # gain in squared error of the share
        out.append(_grow(cells.x[use], pos[use] - share * n, n, depth, pick, lambda g, h, s=share: float(np.clip(s + g / max(h, 1e-9), 0, 1)), 1.0))
    return out


def as_column(node: Node, features: Sequence[Column]) -> Column:
    if len(node) == 1:
        return F.lit(float(node[0]))
    f, v, left, right = node
    return F.when(features[f] <= v, as_column(left, features)).otherwise(as_column(right, features))


def boosted_column(model: tuple[float, list[Node]], features: Sequence[Column]) -> Column:
    z = F.lit(model[0])
    for tree in model[1]:
        z = z + as_column(tree, features)
    return 1 / (1 + F.exp(-z))


def forest_column(model: list[Node], features: Sequence[Column]) -> Column:
    if not model:
        return F.lit(0.0)
    z = F.lit(0.0)
    for tree in model:
        z = z + as_column(tree, features)
    return z / len(model)


def calibrated(scores: np.ndarray, cells: Cells, precision: float) -> float:
    """The lowest score from which on the cases are positive with ``precision``; above 1 if there is none."""
    order = np.argsort(-scores, kind="stable")
    best, pos, neg = 1.1, 0.0, 0.0
    s, p, q = scores[order], cells.pos[order], cells.neg[order]
    for i in range(len(s)):
        pos, neg = pos + p[i], neg + q[i]
        if (i + 1 == len(s) or s[i + 1] < s[i]) and pos and pos / (pos + neg) >= precision:
            best = float(s[i])
    return best
