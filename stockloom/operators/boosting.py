"""Histogram gradient boosting: features binned once, trees grown best leaf first, sums made in the tasks.

Rows become one byte a feature; rows with the same bytes are one row with a weight. A step sends the tree so far to the
tasks; each adds up gradients of its rows by leaf, feature and bin, the sums are reduced between the tasks, and the driver
gets one histogram for each leaf that is asked for, whose size is fixed by features and bins. Leaves that may be split next
are asked for together, the larger of two siblings is the difference to their parent, so a tree takes about as many steps
as it is deep instead of one for each split.

Gradients are rounded to fixed-point numbers, so sums don't depend on the order of rows or tasks and the same table gives
the same trees however it is spread (up to 2^53 / 2^20 in sum). The state of the fit is a set of row blocks in memory that
each tree maps to the next; it is an RDD because a fit takes some thousand steps, and planning a query takes longer than
such a step. It is checkpointed every ``CHECKPOINT_EVERY`` trees in the shared folder, from where a lost executor's part is
computed again. A table of up to ``BLOCK_ROWS`` different rows is one block; there is nothing to reduce between tasks then, and
the same steps follow each other inside its task, with the same trees as result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockloom.functions.quantiles import range_parts
from stockloom.shipping import share, ship_with_tasks
from stockloom.sources.durable import drop_folder, durable, ensure_checkpoint_dir

ship_with_tasks(__name__)

BINS, SCALE = 255, float(1 << 20)
BLOCK_ROWS, CHECKPOINT_EVERY, FLAT_PARTS = 500_000, 20, 32
SQUARED, LOGISTIC = "squared", "logistic"
NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double"


# --- bins ---------------------------------------------------------------------------------------------------------


def bin_edges(frame: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature, halfway between the values on either side.

    A feature with at most ``bins`` different values has a bin for each of them, others have bins of about equal weight.
    Values are counted over all rows, spread over the tasks in their order; the driver gets at most ``bins`` bounds each.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(features)]))
    counts = frame.select(each.alias("x")).groupBy("x.f", "x.v").agg(F.count("*").alias("c"))
    counts = durable(range_parts(counts, "f", "v"), "feature-values")
    before = Window.partitionBy("f").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("f", "part").agg(F.sum("c").alias("rows"), F.count("*").alias("kinds"))
    parts = parts.select("f", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"), F.sum("rows").over(Window.partitionBy("f")).alias("total"), F.sum("kinds").over(Window.partitionBy("f")).alias("kinds"))
    within = Window.partitionBy("f", "part").orderBy("v")
    upto = F.col("offset") + F.sum("c").over(within)
    placed = counts.join(parts, ["f", "part"]).withColumn("bin", F.when(F.col("kinds") > bins, F.floor((upto - F.col("c")) * bins / F.col("total"))))
    few, many = placed.where("bin is null").select("f", F.col("v").alias("low"), F.col("v").alias("high")), placed.where("bin is not null")
    many = many.groupBy("f", "bin").agg(F.min("v").alias("low"), F.max("v").alias("high")).drop("bin")
    found = few.unionByName(many).toPandas().sort_values(["f", "low"])
    out = []
    for i in range(len(features)):
        one = found[found.f == i]
        low, high = one.low.to_numpy(float), one.high.to_numpy(float)
        out.append((high[:-1] + low[1:]) / 2 if len(one) else np.zeros(0))
    return out


def binned_rows(frame: DataFrame, features: list[str], label: str, edges: list[np.ndarray]) -> DataFrame:
    """``bins, n, s``: a byte for each feature, rows that have these bytes, sum of their labels in fixed point."""
    load = share(frame.sparkSession.sparkContext, edges)

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = load()
        for batch in batches:
            columns = [np.searchsorted(e, batch.column(i).to_numpy(zero_copy_only=False), side="left").astype(np.uint8) for i, e in enumerate(bounds)]
            raw = np.ascontiguousarray(np.stack(columns, axis=1)).tobytes()
            fixed = pa.py_buffer(raw)
            data = pa.Array.from_buffers(pa.binary(len(bounds)), batch.num_rows, [None, fixed]).cast(pa.binary())
            y = np.rint(batch.column(len(bounds)).to_numpy(zero_copy_only=False) * SCALE).astype(np.int64)
            yield pa.RecordBatch.from_arrays([data, pa.array(y)], ["bins", "s"])

    values = frame.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"))
    return values.mapInArrow(to_bytes, "bins binary, s bigint").groupBy("bins").agg(F.count("*").alias("n"), F.sum("s").alias("s"))


@dataclass
class Block:
    """Rows of a task: bins (rows x features), weights, label sums, running score before the link."""

    bins: np.ndarray
    n: np.ndarray
    s: np.ndarray
    raw: np.ndarray


def _blocks(rows: DataFrame, width: int, parts: int, base: float) -> RDD:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            bins = np.frombuffer(b"".join(table.column(0).to_pylist()), np.uint8)
            data = [bins.tobytes(), table.column(1).to_numpy().astype("<i8").tobytes(), table.column(2).to_numpy().astype("<i8").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.large_binary()) for x in data], ["bins", "n", "s"])

    def unpack(row) -> Block:
        n = np.frombuffer(row.n, "<i8").astype(float)
        return Block(np.frombuffer(row.bins, np.uint8).reshape(-1, width), n, np.frombuffer(row.s, "<i8") / SCALE, np.full(len(n), base))

    return rows.select("bins", "n", "s").repartition(parts).mapInArrow(pack, "bins binary, n binary, s binary").rdd.map(unpack)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


# --- one tree -----------------------------------------------------------------------------------------------------


@dataclass
class Growing:
    """A tree that is being grown; a node's children exist once its split has been looked into."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    sums: list[np.ndarray] = field(default_factory=list)  # gradient, rows, curvature
    split_sums: list[tuple[np.ndarray, np.ndarray] | None] = field(default_factory=list)
    histogram: list[np.ndarray | None] = field(default_factory=list)

    def add(self, sums: np.ndarray, depth: int) -> int:
        for column, value in ((self.feature, -1), (self.cut, -1), (self.left, -1), (self.depth, depth), (self.gain, 0.0), (self.sums, sums), (self.split_sums, None), (self.histogram, None)):
            column.append(value)
        return len(self.feature) - 1


def leaf_of(bins: np.ndarray, feature: list[int], cut: list[int], left: list[int]) -> np.ndarray:
    """Node of each row; a node's children are neighbours and come after it."""
    node = np.zeros(len(bins), np.int32)
    for k, below in enumerate(left):
        if below >= 0:
            at = np.flatnonzero(node == k)
            node[at] = below + (bins[at, feature[k]] > cut[k])
    return node


def gradients(loss: str, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Downhill gradient and curvature of each row; fixed-point numbers but for the squared loss, whose curvature is 1."""
    if loss == SQUARED:
        return np.rint((b.s - b.n * b.raw) * SCALE), b.n
    p = 1 / (1 + np.exp(-b.raw))
    return np.rint((b.s - b.n * p) * SCALE), np.rint(b.n * p * (1 - p) * SCALE)


def histograms(b: Block, loss: str, tree: tuple[list[int], list[int], list[int]], wanted: list[int]) -> np.ndarray:
    """Sums of gradient, rows and curvature by wanted node, feature and bin."""
    slot = np.full(len(tree[0]), -1, np.int32)
    slot[wanted] = np.arange(len(wanted))
    place = slot[leaf_of(b.bins, *tree)]
    keep = np.flatnonzero(place >= 0)
    part = Block(b.bins[keep], b.n[keep], b.s[keep], b.raw[keep])
    g, h = gradients(loss, part)
    channels = [g, part.n] if loss == SQUARED else [g, part.n, h]
    first = place[keep] * 256
    out = np.zeros((3, len(wanted), b.bins.shape[1], 256))
    for f in range(b.bins.shape[1]):
        key = first + part.bins[:, f]
        for c, w in enumerate(channels):
            out[c, :, f] = np.bincount(key, weights=w, minlength=len(wanted) * 256).reshape(-1, 256)
    if loss == SQUARED:
        out[2] = out[1] * SCALE
    return out


def best_split(histogram: np.ndarray, l2: float, min_leaf: int) -> tuple[float, int, int, np.ndarray, np.ndarray]:
    """Gain, feature, last bin on the left, and the sums on both sides; of equal gains the first feature and bin."""
    total = histogram[:, 0].sum(axis=1)
    left = np.cumsum(histogram, axis=2)
    right = total[:, None, None] - left
    fits = (left[1] >= min_leaf) & (right[1] >= min_leaf)

    def worth(sums: np.ndarray) -> np.ndarray:
        return (sums[0] / SCALE) ** 2 / np.maximum(sums[1] + l2, 1e-300)

    gain = np.where(fits, worth(left) + worth(right) - worth(total), -np.inf)
    f, cut = divmod(int(gain.argmax()), gain.shape[1])
    return float(gain[f, cut]), f, cut, left[:, f, cut], right[:, f, cut]


def grow(ask: Callable[[Growing, list[int]], np.ndarray], leaves: int, depth: int, l2: float, min_leaf: int) -> tuple[Growing, list[int]]:
    """A tree and its split nodes, largest gain first. ``ask`` gives the histograms of nodes, in one step for all."""
    tree = Growing()
    root = tree.add(np.zeros(3), 0)
    _learn(tree, root, ask(tree, [root])[:, 0], l2, min_leaf)
    tree.sums[root] = tree.histogram[root][:, 0].sum(axis=1)
    while True:
        heap, split, unknown = [(-tree.gain[root], root)], [], []
        while heap and len(split) < leaves - 1:
            gain, k = heapq.heappop(heap)
            if gain >= 0:
                break
            split.append(k)
            if tree.left[k] >= 0:
                for c in (tree.left[k], tree.left[k] + 1):
                    heapq.heappush(heap, (-tree.gain[c], c))
            elif len(split) < leaves - 1 and tree.depth[k] + 1 < depth and max(x[1] for x in tree.split_sums[k]) >= 2 * min_leaf:
                unknown.append(k)
        if not unknown:
            return tree, split
        smaller = []
        for k in unknown:
            sums = tree.split_sums[k]
            tree.left[k] = tree.add(sums[0], tree.depth[k] + 1)
            tree.add(sums[1], tree.depth[k] + 1)
            smaller.append(tree.left[k] + int(sums[1][1] < sums[0][1]))
        found = ask(tree, smaller)
        for i, (k, small) in enumerate(zip(unknown, smaller, strict=True)):
            other = 2 * tree.left[k] + 1 - small
            _learn(tree, small, found[:, i], l2, min_leaf)
            _learn(tree, other, tree.histogram[k] - found[:, i], l2, min_leaf)
            tree.histogram[k] = None


def _learn(tree: Growing, k: int, histogram: np.ndarray, l2: float, min_leaf: int) -> None:
    gain, f, cut, left, right = best_split(histogram, l2, min_leaf)
    tree.histogram[k], tree.split_sums[k] = histogram, (left, right)
    tree.gain[k], tree.feature[k], tree.cut[k] = (gain, f, cut) if gain > 1e-12 else (0.0, -1, -1)


@dataclass
class Tree:
    """Nodes in arrays; children of ``left[k]`` are neighbours; ``feature`` -1 marks a leaf with its ``value``."""

    feature: list[int]
    cut: list[int]
    left: list[int]
    value: list[float]
    gain: list[float]


def finished(tree: Growing, split: list[int], loss: str, step: float, l2: float) -> Tree:
    """Only what is split in the end, numbered anew; leaf values by a Newton step."""
    out = Tree([-1], [-1], [-1], [0.0], [0.0])
    chosen = set(split)

    def value(sums: np.ndarray) -> float:
        weight = sums[1] if loss == SQUARED else sums[2] / SCALE
        return step * float(sums[0] / SCALE / (weight + l2)) if weight + l2 > 1e-12 else 0.0

    todo = [(0, 0, tree.sums[0])]
    while todo:
        k, place, sums = todo.pop()
        if k not in chosen:
            out.value[place] = value(sums)
            continue
        below = len(out.feature)
        out.feature[place], out.cut[place], out.left[place], out.gain[place] = tree.feature[k], tree.cut[k], below, tree.gain[k]
        for i in range(2):
            for column, empty in ((out.feature, -1), (out.cut, -1), (out.left, -1), (out.value, 0.0), (out.gain, 0.0)):
                column.append(empty)
            child = tree.left[k] + i if tree.left[k] >= 0 else -1
            todo.append((child, below + i, tree.split_sums[k][i]))
    return out


def moved(b: Block, t: Tree) -> Block:
    """The block after a tree."""
    return Block(b.bins, b.n, b.s, b.raw + np.array(t.value)[leaf_of(b.bins, t.feature, t.cut, t.left)])


def boosted(b: Block, loss: str, rounds: int, step: float, leaves: int, depth: int, l2: float, min_leaf: int) -> list[Tree]:
    """All trees of a table that is one block."""
    trees: list[Tree] = []
    for _ in range(rounds):
        grown, split = grow(lambda t, wanted, b=b: histograms(b, loss, (t.feature, t.cut, t.left), wanted), leaves, depth, l2, min_leaf)
        if not split:
            break
        trees.append(finished(grown, split, loss, step, l2))
        b = moved(b, trees[-1])
    return trees


# --- the model ----------------------------------------------------------------------------------------------------


@dataclass
class BoostedTrees:
    features: list[str]
    loss: str
    base: float
    edges: list[np.ndarray]
    trees: list[Tree]

    def score(self, df: DataFrame, output: str, inputs: list[str] | None = None) -> DataFrame:
        """``df`` with the prediction (a chance for the logistic loss). Null counts as 0; nothing is shuffled."""
        load = share(df.sparkSession.sparkContext, (self.edges, self.trees))
        base, chance = self.base, self.loss == LOGISTIC

        @F.pandas_udf("double")
        def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            edges, trees = load()
            for columns in batches:
                bins = np.stack([np.searchsorted(e, c.to_numpy(dtype=float), side="left") for e, c in zip(edges, columns, strict=True)], axis=1).astype(np.uint8)
                raw = np.full(len(bins), base)
                for t in trees:
                    raw += np.array(t.value)[leaf_of(bins, t.feature, t.cut, t.left)]
                yield pd.Series(1 / (1 + np.exp(-raw)) if chance else raw)

        return df.withColumn(output, predict(*[_number(c) for c in inputs or self.features]))

    def importance(self) -> list[float]:
        """Share of each feature in the gain of all splits; zeros without a split."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain, strict=True):
                if f >= 0:
                    total[f] += g
        return (total / total.sum() if total.sum() else total).tolist()

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The model as a table, thresholds in the features' own unit (a value up to the threshold goes left)."""
        rows = [
            (i, k, f, float(self.edges[f][t.cut[k]]) if f >= 0 else None, t.left[k], t.left[k] + 1 if f >= 0 else -1, t.value[k], t.gain[k])
            for i, t in enumerate(self.trees)
            for k, f in enumerate(t.feature)
        ]
        return spark.createDataFrame(rows, NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        """Node table and description below ``path``, replacing what is there."""
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = [(self.features, self.loss, self.base, [e.tolist() for e in self.edges], len(self.trees))]
        spark.createDataFrame(about, "features array<string>, loss string, base double, edges array<array<double>>, trees int").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: list[str] | None = None) -> BoostedTrees:
        """The saved model; an error if it is incomplete or was fitted on other features than ``features``."""
        about = spark.read.parquet(f"{path}/about").first()
        if features is not None and list(features) != list(about.features):
            raise ValueError(f"the model at {path} was fitted on {about.features}, not on {features}")
        rows = spark.read.schema(NODES).parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
        if rows.tree.nunique() != about.trees:
            raise ValueError(f"the model at {path} has {rows.tree.nunique()} of {about.trees} trees")
        edges = [np.array(e) for e in about.edges]
        trees = []
        for _, t in rows.groupby("tree"):
            cut = [int(np.searchsorted(edges[f], x)) if f >= 0 else -1 for f, x in zip(t.feature, t.threshold, strict=True)]
            trees.append(Tree(t.feature.tolist(), cut, t.left.tolist(), t.value.tolist(), t.gain.tolist()))
        return cls(list(about.features), about.loss, about.base, edges, trees)


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def fit_boosted_trees(
    frame: DataFrame,
    features: list[str],
    label: str,
    loss: str = SQUARED,
    rounds: int = 300,
    step: float = 0.04,
    leaves: int = 27,
    depth: int = 1 << 30,
    l2: float = 0.2,
    min_leaf: int = 15,
    inputs: list[str] | None = None,
) -> BoostedTrees:
    """Fit on all rows of ``frame``; null features count as 0, null labels are left out.

    ``inputs`` names the columns of the features where they differ. Without rows, or with a single class, the model is a
    constant. Ties between splits go to the first feature and the lowest bound.
    """
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    names = inputs or features
    values = frame.where(F.col(label).isNotNull()).select(*[_number(c).alias(f"x{i}") for i, c in enumerate(names)], F.col(label).cast("double").alias("y"))
    inside = [f"x{i}" for i in range(len(names))]
    edges = bin_edges(values, inside)
    rows = durable(binned_rows(values, inside, "y", edges), "binned-rows")
    total = rows.agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    if not total.n:
        return BoostedTrees(list(features), loss, 0.0, edges, [])
    mean = total.s / SCALE / total.n
    if loss == LOGISTIC:
        if not 0 < mean < 1:
            return BoostedTrees(list(features), loss, 30.0 if mean >= 1 else -30.0, edges, [])
        base = math.log(mean / (1 - mean))
    else:
        base = mean
    parts = math.ceil(total.kinds / BLOCK_ROWS)
    levels = 1 if parts <= FLAT_PARTS else 2
    state = _blocks(rows, len(names), parts, base)
    if parts == 1:
        found = state.map(lambda b: boosted(b, loss, rounds, step, leaves, depth, l2, min_leaf)).first()
        return BoostedTrees(list(features), loss, base, edges, found)
    state.persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[Tree] = []
    written: list[str] = []
    before = None
    for number in range(rounds):

        def ask(tree: Growing, wanted: list[int], state: RDD = state) -> np.ndarray:
            shape = (list(tree.feature), list(tree.cut), list(tree.left))
            return state.map(lambda b: histograms(b, loss, shape, wanted)).treeReduce(np.add, depth=levels)

        grown, split = grow(ask, leaves, depth, l2, min_leaf)
        if before is not None:
            before.unpersist()
        if not split:
            break
        tree = finished(grown, split, loss, step, l2)
        trees.append(tree)
        before, state = state, state.map(lambda b, t=tree: moved(b, t))
        state.persist(StorageLevel.MEMORY_AND_DISK)
        if (number + 1) % CHECKPOINT_EVERY == 0 and number + 1 < rounds:
            state.checkpoint()
            state.count()
            written.append(state.getCheckpointFile())
            for old in written[:-1]:
                drop_folder(spark, old)
            written = written[-1:]
    state.unpersist()
    for old in written:
        drop_folder(spark, old)
    return BoostedTrees(list(features), loss, base, edges, trees)
