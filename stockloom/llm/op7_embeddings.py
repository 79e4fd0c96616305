"""Near-duplicate embeddings by an epsilon grid order join.

Two unit vectors with a cosine of ``threshold`` or more lie within epsilon = sqrt(2 - 2 threshold) of each other, and so do
their projections. Vectors are sorted by the cells, epsilon wide, of their leading principal dimensions; the sequence is
cut into tiles of bounded size. Pairs of sequence intervals are joined recursively: intervals whose boxes in the principal
dimensions are farther apart than epsilon are skipped, others are halved, first from the whole sequence down to tiles as
joins of small tables, then inside a task from tiles down to blocks, whose vectors are compared.

Two more bounds work inside a task: the length of what lies outside the axes is one more coordinate of the boxes, and a pair
of vectors is compared only if the product of their places on ``AXES`` axes and that length allows a link.

Equal vectors are one vector with a weight. A task hands on numbers of links and a spanning forest of the links it found,
never the pairs, so a dense group costs time in proportion to its pairs but no space.

The principal dimensions, of each length of vectors its own, come from a bounded sample (``SAMPLE_VALUES`` numbers); they
decide what can be skipped, never what is linked. The hash of a vector is the last key of the order, so that vectors with
one place still fall into tiles of bounded size. Tiles are as large as a task's memory allows, so that a vector is copied
about as often as the square root of the number of tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import shuffle_parts, stored, table
from stockloom.llm.links import components
from stockloom.shipping import share, ship_with_tasks

THRESHOLD = 0.95
TILE, TILE_VALUES, BLOCK, LEADING, AXES, SAMPLE_VALUES, FAN_OUT = 65_536, 4_000_000, 512, 4, 16, 1_000_000, 4
DENSE, PAIR_VALUES = 16, 4_000_000  # from one possible pair in 16 a block is compared as a whole; numbers gathered at a time
BROADCAST_ROWS = 1_000_000
MARGIN = 1e-3  # single precision only rules pairs out, by this much


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by powers of two first, so that no square leaves the range of doubles."""
    exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))[1]
    scaled = np.ldexp(vectors, -exponent[:, None])
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def principal(sample: np.ndarray, leading: int = AXES) -> np.ndarray:
    """Orthonormal columns of the leading principal dimensions; fewer if the sample spans fewer."""
    centred = sample - sample.mean(axis=0)
    if len(sample) < sample.shape[1]:
        return np.linalg.svd(centred, full_matrices=False)[2][:leading].T
    return np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :leading]


class Join:
    """Recursive join of sequence intervals whose rows are in grid order.

    A row's shadow is its projection on the axes with the length of the rest as a last coordinate: a unit vector of few
    dimensions. Shadows are never farther apart than their vectors, so the product of two shadows is at least the cosine.
    Boxes of shadows rule out pairs of intervals, products of shadows single pairs; cosines are computed of what is left.
    """

    def __init__(self, vectors: np.ndarray, axes: np.ndarray, weights: np.ndarray, threshold: float) -> None:
        exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))[1]
        self.vectors = np.ldexp(vectors, -exponent[:, None])
        self.norms = np.linalg.norm(self.vectors, axis=1)
        projected = self.vectors @ axes / self.norms[:, None]
        rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", projected, projected)))
        self.shadows = np.column_stack([projected, rest]).astype(np.float32)
        self.weights, self.threshold = weights, threshold
        self.reach = 2 - 2 * threshold + MARGIN
        self.links = np.zeros(len(vectors), np.int64)
        self.group = np.arange(len(vectors))
        self.members = [[i] for i in range(len(vectors))]
        self.forest: list[tuple[int, int]] = []
        self.compared = 0

    def join(self, a: range, b: range) -> None:
        if not len(a) or not len(b):
            return
        if a != b:
            x, y = self.shadows[a.start : a.stop], self.shadows[b.start : b.stop]
            gap = np.maximum(0, np.maximum(y.min(0) - x.max(0), x.min(0) - y.max(0)))
            if gap @ gap > self.reach:
                return
        if len(a) <= BLOCK and len(b) <= BLOCK:
            self._compare(a, b)
        elif a == b:
            low, high = a[: len(a) // 2], a[len(a) // 2 :]
            self.join(low, low)
            self.join(low, high)
            self.join(high, high)
        elif len(a) >= len(b):
            self.join(a[: len(a) // 2], b)
            self.join(a[len(a) // 2 :], b)
        else:
            self.join(a, b[: len(b) // 2])
            self.join(a, b[len(b) // 2 :])

    def _compare(self, a: range, b: range) -> None:
        rows, columns = slice(a.start, a.stop), slice(b.start, b.stop)
        possible = self.shadows[rows] @ self.shadows[columns].T >= self.threshold - MARGIN
        if a == b:
            possible = np.triu(possible, 1)
        i, j = np.nonzero(possible)
        self.compared += len(i)
        if len(i) * DENSE > possible.size:
            cosine = self.vectors[rows] @ self.vectors[columns].T / (self.norms[rows, None] * self.norms[columns])
            linked = cosine[i, j] >= self.threshold
        else:
            linked = np.zeros(len(i), bool)
            step = max(1, PAIR_VALUES // self.vectors.shape[1])
            for s in range(0, len(i), step):
                x, y = i[s : s + step] + a.start, j[s : s + step] + b.start
                product = np.einsum("ij,ij->i", self.vectors[x], self.vectors[y])
                linked[s : s + step] = product / (self.norms[x] * self.norms[y]) >= self.threshold
        i, j = i[linked] + a.start, j[linked] + b.start
        np.add.at(self.links, i, self.weights[j])
        np.add.at(self.links, j, self.weights[i])
        new = self.group[i] != self.group[j]
        i, j = i[new], j[new]
        cuts = np.flatnonzero(np.diff(i)) + 1
        for row, others in zip(i[np.concatenate([[0], cuts])].tolist() if len(i) else [], np.split(j, cuts), strict=False):
            first = np.unique(self.group[others], return_index=True)[1]
            for other in others[first].tolist():
                self._unite(row, other)

    def _unite(self, i: int, j: int) -> None:
        x, y = int(self.group[i]), int(self.group[j])
        if x == y:
            return
        self.forest.append((i, j))
        if len(self.members[x]) < len(self.members[y]):
            x, y = y, x
        self.group[self.members[y]] = x
        self.members[x] += self.members[y]
        self.members[y] = []


class Axes:
    """Orthonormal axes by length of vectors; a length without any takes its first components."""

    def __init__(self, found: dict[int, np.ndarray]) -> None:
        self.found = found

    def of(self, size: int) -> np.ndarray:
        return self.found[size] if size in self.found else np.eye(size)[:, :AXES]


def joined_tiles(axes, threshold: float):
    """Function of the rows of one pair of tiles: numbers of links (v null) and the edges of a forest (n null).

    A tile marked as its own is also joined with itself.
    """

    def join(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        a = rows.column("a")[0].as_py()
        tile, own = rows.column("tile").to_numpy(), np.array(rows.column("own").to_pylist(), bool)
        flat = rows.column("vector").combine_chunks().flatten()
        vectors = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows.num_rows, -1)
        chosen = axes().of(vectors.shape[1])
        places = unit(vectors) @ chosen[:, :LEADING]
        order = np.lexsort([*places.T[::-1], *np.floor(places / np.sqrt(2 - 2 * threshold)).T[::-1], tile != a])
        nodes = rows.column("node").to_numpy()[order]
        work = Join(vectors[order], chosen, rows.column("copies").to_numpy()[order], threshold)
        first = int((tile == a).sum())
        sides = range(first), range(first, len(nodes))
        for side in sides:
            if len(side) and own[order[side.start]]:
                work.join(side, side)
        work.join(*sides)
        counted = np.flatnonzero(work.links)
        u = np.concatenate([nodes[counted], nodes[np.array([i for i, _ in work.forest], int)]])
        v = [None] * len(counted) + nodes[np.array([j for _, j in work.forest], int)].tolist()
        n = work.links[counted].tolist() + [None] * len(work.forest)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "n": pa.array(n, pa.int64())})

    return join


def tile_pairs(tiles: DataFrame, leading: int, reach: float) -> DataFrame:
    """Pairs of tiles (a <= b) that may hold vectors within reach: from the root down, boxes too far apart are left out."""
    count = tiles.agg(F.max("tile").alias("t")).first()["t"] + 1
    levels = 0
    while FAN_OUT**levels < count:
        levels += 1
    bounds = [f(F.col("place")[k]).alias(f"{name}{k}") for k in range(leading) for name, f in (("low", F.min), ("high", F.max))]
    boxes = stored(tiles.groupBy("tile", "size").agg(*bounds), "boxes")
    pairs = tiles.sparkSession.range(1).select(F.lit(0).alias("a"), F.lit(0).alias("b"))
    for level in reversed(range(levels)):
        node = F.floor(F.col("tile") / FAN_OUT**level).cast("int")
        ends = [F.min("size").alias("low_size"), F.max("size").alias("high_size")] + [f(f"{name}{k}").alias(f"{name}{k}") for k in range(leading) for name, f in (("low", F.min), ("high", F.max))]
        nodes = boxes.groupBy(node.alias("node")).agg(*ends)
        below = F.sequence(F.lit(0), F.lit(FAN_OUT - 1))
        pairs = pairs.select("a", "b", F.explode(below).alias("i")).select("a", "b", "i", F.explode(below).alias("j"))
        pairs = pairs.select((F.col("a") * FAN_OUT + F.col("i")).alias("a"), (F.col("b") * FAN_OUT + F.col("j")).alias("b")).where("a <= b")
        x, y = nodes.alias("x"), nodes.alias("y")
        far = sum((F.greatest(F.lit(0.0), F.col(f"y.low{k}") - F.col(f"x.high{k}"), F.col(f"x.low{k}") - F.col(f"y.high{k}")) ** 2 for k in range(leading)), F.lit(0.0))
        same_size = (F.col("x.low_size") <= F.col("y.high_size")) & (F.col("y.low_size") <= F.col("x.high_size"))
        pairs = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).where((far <= reach) & same_size).select("a", "b")
    return pairs


def sides(pairs: DataFrame) -> DataFrame:
    """``a``, ``b``, ``tile``, ``own``: the tiles of every task. A tile is joined with itself beside its first partner, or alone."""
    apart = pairs.where("a < b")
    ends = apart.select(F.col("a").alias("tile"), F.col("b").alias("other")).union(apart.select("b", "a"))
    first = ends.groupBy("tile").agg(F.min("other").alias("first"))
    alone = pairs.where("a = b").select(F.col("a").alias("tile")).join(first, "tile", "left_anti")
    both = ends.join(first, "tile").select(F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", (F.col("other") == F.col("first")).alias("own"))
    return both.union(alone.select("tile", "tile", "tile", F.lit(True)))


def valid(vector: Column) -> Column:
    """Neither null nor empty nor all zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def tile_count(spark: SparkSession, vectors: int, values: int, tile: int) -> int:
    """Tiles of bounded size, and enough for a task a core: of t tiles each vector is copied to t - 1 tasks at most."""
    spread = (1 + math.isqrt(8 * spark.sparkContext.defaultParallelism + 1)) // 2
    return max(1, -(-vectors // tile), -(-values // TILE_VALUES), min(spread, -(-vectors // BLOCK)))


def near_duplicates(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, vectors of different
    lengths neither. Rows with equal vectors link with each other; links are counted by rows. Rows that share an id but
    not their vector are vectors of their own. A null id takes part but is never a component's smallest id: a component
    of null ids only has none, and all its rows are kept. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    kind = "array<float>" if embeddings.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast(kind).alias("vector"))
    rows = rows.withColumn("valid", valid(F.col("vector")))
    rows = rows.withColumn("h", F.when(F.col("valid"), F.xxhash64("vector"))).withColumn("g", F.when(F.col("valid"), F.xxhash64(F.lit(1), "vector")))
    distinct = rows.where("valid").groupBy("h", "g").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    distinct = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = distinct.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("most"), F.sum(F.size("vector").cast("bigint")).alias("total")).first()
    if not sizes["n"]:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    leading = min(LEADING, sizes["most"])
    share_of = min(1.0, SAMPLE_VALUES / sizes["total"])
    sample: dict[int, list[np.ndarray]] = {}
    for r in distinct.where(F.pmod(F.col("h"), F.lit(1 << 30)) < F.lit(int(share_of * (1 << 30)))).select("vector").toLocalIterator():
        sample.setdefault(len(r["vector"]), []).append(np.array(r["vector"], np.float64))
    axes = share(spark.sparkContext, Axes({d: principal(unit(np.array(found)), AXES) for d, found in sample.items() if len(found) > 1}))
    n_tiles = tile_count(spark, sizes["n"], sizes["total"], tile)
    # only places move to be sorted, vectors later to their tiles
    placed = distinct.select("node", F.size("vector").alias("size"), "h", _places(axes, leading)("vector").alias("place"))
    width = float(np.sqrt(2 - 2 * threshold))
    cells = [F.floor(F.col("place")[k] / width) for k in range(leading)]
    parts = max(n_tiles, shuffle_parts(spark))
    ordered = placed.repartitionByRange(parts, "size", *cells, *[F.col("place")[k] for k in range(leading)], "h").withColumn("part", F.spark_partition_id())
    ordered = stored(ordered.select("part", "size", "node", "place"), "grid-order")
    last = ordered.agg(F.max("part").alias("p")).first()["p"] + 1
    tiles = ordered.withColumn("tile", F.floor(F.col("part") * n_tiles / last).cast("int"))
    pairs = stored(tile_pairs(tiles, leading, 2 - 2 * threshold + 1e-6), "tile-pairs")
    place = tiles.select("node", "tile", "size")
    if sizes["n"] <= BROADCAST_ROWS:
        place = F.broadcast(place)
    work = distinct.select("node", "copies", "vector").join(place, "node").join(sides(pairs), "tile")
    # vectors of one length form a matrix
    found = work.select("a", "b", "tile", "own", "size", "node", "copies", "vector").groupBy("a", "b", "size").applyInArrow(joined_tiles(axes, threshold), "u bigint, v bigint, n bigint")
    found = stored(found, "vector-links")
    counts = found.where("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
    ids = distinct.select("h", "g", "node", "id", "copies")
    members = stored(components(found.where("v is not null"), "u", "v").join(ids.select("node", "id"), "node"), "vector-roots")
    least = stored(members.groupBy("root").agg(F.min("id").alias("least")), "smallest-ids")
    known = ids.join(counts, "node", "left").join(members.join(least, "root").select("node", "least"), "node", "left")
    known = known.select("h", "g", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "id").alias("least"))
    out = rows.select("vec_id", "h", "g").join(known, ["h", "g"], "left")
    component = F.coalesce("least", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("vec_id").eqNullSafe(component)).alias("kept"))


def _places(axes, leading: int):
    """UDF: a vector's place on the leading axes of its length, filled up with zeros."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def place(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
        sizes = np.diff(ends)
        found = np.zeros((len(sizes), leading))
        for d in np.unique(sizes).tolist():
            here = np.flatnonzero(sizes == d)
            projected = unit(flat[ends[here][:, None] + np.arange(d)]) @ axes().of(d)[:, :leading]
            found[here, : projected.shape[1]] = projected
        offsets = np.arange(0, found.size + 1, leading, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))

    return place


def op7_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ship_with_tasks(__name__)
