"""A random forest of two classes over numeric features: trees are trained apart, one per group."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES = 15
DEPTH = 8
LEAST = 3
#: Rows that train the forest at most; each tree sees about half of them.
SAMPLE_ROWS = 20_000


class Tree(NamedTuple):
    """Nodes in rows: the feature (-1 in a leaf), the threshold, the two children, and the share of label 1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray


def _split(x: np.ndarray, y: np.ndarray, tried: np.ndarray) -> tuple[int, float] | None:
    """The feature and threshold that leave the lowest Gini impurity."""
    best, found = 2 * y.sum() * (1 - y.mean()) - 1e-9, None
    for feature in tried:
        order = np.argsort(x[:, feature], kind="stable")
        values, ones = x[order, feature], np.cumsum(y[order])
        cut = np.flatnonzero(values[1:] > values[:-1])
        if not len(cut):
            continue
        low = cut + 1
        a, b = ones[cut], ones[-1] - ones[cut]
        left = 2 * a * (1 - a / low)
        right = 2 * b * (1 - b / (len(y) - low))
        i = int(np.argmin(left + right))
        if left[i] + right[i] < best:
            best, found = left[i] + right[i], (int(feature), float((values[cut[i]] + values[cut[i] + 1]) / 2))
    return found


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH) -> Tree:
    nodes: list[list[float]] = []

    def node(rows: np.ndarray, left_depth: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, -1, -1, float(y[rows].mean()) if len(rows) else 0.0])
        if left_depth and len(rows) >= 2 * LEAST and 0 < y[rows].mean() < 1:
            width = x.shape[1]
            tried = rng.permutation(width)[: max(1, int(np.ceil(np.sqrt(width))))]
            split = _split(x[rows], y[rows], tried)
            if split is not None:
                low = x[rows, split[0]] <= split[1]
                nodes[at][:2] = split
                nodes[at][2] = node(rows[low], left_depth - 1)
                nodes[at][3] = node(rows[~low], left_depth - 1)
        return at

    node(np.arange(len(y)), depth)
    every = np.array(nodes)
    return Tree(*(every[:, i].astype(int if i in (0, 2, 3) else float) for i in range(5)))


def chance(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    """The mean share of label 1 over the trees; 0 without trees."""
    total = np.zeros(len(x))
    for tree in trees:
        at = np.zeros(len(x), int)
        while True:
            inner = tree.feature[at] >= 0
            if not inner.any():
                break
            rows = np.flatnonzero(inner)
            low = x[rows, tree.feature[at[rows]]] <= tree.threshold[at[rows]]
            at[rows] = np.where(low, tree.left[at[rows]], tree.right[at[rows]])
        total += tree.share[at]
    return total / max(1, len(trees))


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH, sample: int = SAMPLE_ROWS, seed: int = 3) -> list[Tree]:
    """A forest of findings (features, label 0 or 1). Each tree takes about half of a bounded sample."""
    made = findings.select("features", F.col("label").cast("int").alias("label"))
    keyed = made.withColumn("place", F.xxhash64("features", "label", F.lit(seed)))
    chosen = keyed.orderBy("place").limit(sample)
    bagged = chosen.withColumn(
        "tree", F.explode(F.expr(f"filter(sequence(0, {trees - 1}), t -> xxhash64(place, t) % 2 = 0)"))
    )

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", kind="stable")
        x = np.array(rows.features.tolist(), float)
        tree = grow(x, rows.label.to_numpy(), np.random.default_rng([seed, key[0]]), depth)
        return pd.DataFrame([[key[0], *(values.astype(float).tolist() for values in tree)]])

    arrays = ", ".join(f"{name} array<double>" for name in Tree._fields)
    rows = bagged.groupBy("tree").applyInPandas(run, f"tree int, {arrays}").orderBy("tree").collect()
    kinds = {"feature": int, "left": int, "right": int}
    return [Tree(*(np.array(row[name]).astype(kinds.get(name, float)) for name in Tree._fields)) for row in rows]
