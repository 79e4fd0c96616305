"""Isolation forest: trees grown on small hashed samples, scoring spread over all rows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.shipping import ship_with_tasks

ship_with_tasks(__name__)

NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, size int"
OVERSAMPLE = 4
EULER = 0.5772156649015329


def _expected_depth(n):
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    many = 2.0 * (np.log(np.maximum(n - 1, 1)) + EULER) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, depth_limit: int, rng: np.random.Generator) -> list[tuple]:
    """Random splits until a cell is pure or the depth is used up; nodes as (id, feature, split, left, right, size)."""
    nodes, todo = [], [(0, points, 0)]
    used = 1
    while todo:
        node, cell, depth = todo.pop()
        spread = cell.max(axis=0) > cell.min(axis=0) if len(cell) else np.zeros(points.shape[1], bool)
        if depth >= depth_limit or len(cell) <= 1 or not spread.any():
            nodes.append((node, -1, 0.0, -1, -1, len(cell)))
            continue
        feature = int(rng.choice(np.flatnonzero(spread)))
        values = cell[:, feature]
        split = float(rng.uniform(values.min(), values.max()))
        below = values <= split
        nodes.append((node, feature, split, used, used + 1, len(cell)))
        todo += [(used, cell[below], depth + 1), (used + 1, cell[~below], depth + 1)]
        used += 2
    return nodes


@dataclass
class IsolationForestModel:
    features: list[str]
    sample_rows: int
    trees: list[np.ndarray]  # per tree one row per node: feature, split, left, right, path length at a leaf

    def score(self, df: DataFrame, output: str = "anomaly_score") -> DataFrame:
        """Score in (0, 1], higher is more isolated. The broadcast model is at most trees x 511 nodes."""
        shared = df.sparkSession.sparkContext.broadcast(self.trees)
        scale = float(_expected_depth(self.sample_rows)) or 1.0

        @F.pandas_udf("double")
        def isolation(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            trees = shared.value
            for columns in batches:
                x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
                rows = np.arange(len(x))
                total = np.zeros(len(x))
                for t in trees:
                    feature, left, right = (t[:, i].astype(int) for i in (0, 2, 3))
                    at = np.zeros(len(x), dtype=int)
                    while (inner := feature[at] >= 0).any():
                        goes_left = x[rows, np.maximum(feature[at], 0)] <= t[at, 1]
                        at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
                    total += t[at, 4]
                yield pd.Series(np.exp2(-total / len(trees) / scale))

        return df.withColumn(output, isolation(*[_input(c) for c in self.features]))


def _input(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _uniform(*parts) -> Column:
    """Repeatable number in [0, 1) from the hash of some columns."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def binomial_share(n: int, p: float, k: int) -> float:
    """Chance of ``k`` hits in ``n`` draws."""
    return math.comb(n, k) * p**k * (1 - p) ** (n - k)


def tree_samples(
    df: DataFrame, ids: list[str], features: list[str], rows: int, trees: int, sample: int, seed: int
) -> DataFrame:
    """At most ``sample`` rows for each tree, chosen by hash.

    A row is thinned out by hash before anything is shuffled, so a few thousand rows per tree travel whatever the size
    of the table; the exact cut to ``sample`` happens per tree afterwards.
    """
    key = [F.col(c) for c in ids]
    rate = min(1.0, OVERSAMPLE * sample / max(rows, 1))
    inputs = [_input(c).alias(f"x{i}") for i, c in enumerate(features)]
    # The number of trees that a row enters is drawn first; most rows of a large table enter none and cost one hash.
    shares = [binomial_share(trees, rate, k) for k in range(trees + 1)]
    upto = [sum(shares[: k + 1]) for k in range(trees)]
    count = F.size(F.filter(F.array(*[F.lit(c) for c in upto if c < 1 - 1e-15] or [F.lit(2.0)]), lambda c: _uniform(F.lit(seed), *key) >= c))
    every = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(F.xxhash64(F.lit(seed + 1), t, *key).alias("h"), t.alias("t")))
    chosen = F.when(count > 0, F.transform(F.slice(F.array_sort(every), F.lit(1), count), lambda x: x["t"]))
    drawn = df.withColumn("tree", F.explode(chosen))
    ranked = Window.partitionBy("tree").orderBy(F.xxhash64(F.lit(seed + 2), F.col("tree"), *key), *key)
    return (
        drawn.select("tree", F.row_number().over(ranked).alias("rank"), *inputs)
        .where(F.col("rank") <= sample)
        .drop("rank")
    )


def fit_isolation_forest(
    df: DataFrame, ids: list[str], features: list[str], trees: int = 200, sample: int = 256, seed: int = 42
) -> IsolationForestModel:
    """Grow the trees in parallel, one small group per tree, and bring back the node tables (bounded by the settings)."""
    rows = df.count()
    psi = min(sample, rows)
    limit = max(1, math.ceil(math.log2(max(psi, 2))))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        (tree,) = key
        points = group.drop(columns="tree").to_numpy(dtype=float)
        grown = _grow(points, limit, np.random.default_rng([seed, int(tree)]))
        return pd.DataFrame(
            [(int(tree), *n) for n in grown], columns=["tree", "node", "feature", "split", "left", "right", "size"]
        )

    nodes = (
        tree_samples(df, ids, features, rows, trees, sample, seed)
        .groupBy("tree")
        .applyInPandas(build, NODE_SCHEMA)
        .toPandas()
        .sort_values(["tree", "node"])
    )
    tables = [
        _leaf_paths(t[["feature", "split", "left", "right"]].to_numpy(dtype=float), t["size"].to_numpy())
        for _, t in nodes.groupby("tree")
    ]
    return IsolationForestModel(list(features), psi, tables)


def _leaf_paths(table: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Append the path length of every node: its depth plus the expected depth of what is left in a leaf."""
    depth = np.zeros(len(table))
    for node, (feature, _, left, right) in enumerate(table):
        if feature >= 0:
            depth[[int(left), int(right)]] = depth[node] + 1
    return np.column_stack([table, depth + np.where(table[:, 0] < 0, _expected_depth(sizes), 0.0)])
