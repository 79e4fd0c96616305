"""Jaccard join of word n-gram sets by signature trees.

A set's shingles are hashed to 64 bits; equal sets are one set. Sets that can be similar are first brought together: the
hash range is cut into regions, as many for all sets whose sizes may match, and two sets meet if they agree on the whole
content of a region. Small sets use more regions than a link has differences, so one region always agrees; larger ones use
a fixed number of regions, each of which agrees with a chance above 0.46 for a link at the threshold, so that a link is missed
with a chance below 10^-12. Common passages make sets meet that have little else in common, and ever more of them in a larger
table. So sets that meet are held against each other by the parity of their tokens' lowest bits: no more bits differ than
tokens do, so a pair that differs in more bits than a link may have differences is none. Sets that are left as possible links,
directly or by others, form a group.

Inside a group the trees work: sets sorted by size are the leaves, every node holds the range of the sizes and the bitmaps
of the tokens that any and that all of its sets have. Two trees are traversed together, and a pair of nodes is left out if
its largest possible overlap is too small for a link. What is left is compared exactly, unless it is known to be connected.
The upper nodes of a large group are its classes of size, cut into tiles of bounded size. A class meets itself and the next
one, as the overlap of all others is too small; each pair of tiles is a task's work, which gives a spanning forest of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockloom.llm.bpe import slices, uncollected
from stockloom.llm.common import stored, table
from stockloom.llm.links import components
from stockloom.shipping import hand_back_memory, share, ship_with_tasks
from stockloom.sources.durable import drop_tables

WORDS, SIMILARITY = 5, (80, 100)
MISSED = 1e-12
WIDTH = 2  # steps of the largest ratio of two linked sizes in a class of the regions
CELL = 1 << 40  # tiles of a class of size are numbered from its multiple of this
TILE, TILE_TOKENS, LEAF, BUNDLE = 2048, 2_000_000, 16, 2000
BLOCK, BLOCK_TOKENS, FEW = 32_768, 32_000_000, 16  # sets of a key, and their tokens, that a task holds by their parities; keys with few sets are compared side by side
BROADCAST_ROWS = 1_000_000
CACHED, SLICE = 100_000, 4_000_000  # words a Python worker keeps; bytes of text worked on at a time


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64; constants fixed)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salt(i: int) -> np.uint64:
    return mixed(np.array([i + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]


class Shingles:
    """Sorted distinct shingle hashes of texts; hashes of words are kept from batch to batch."""

    def __init__(self, words: int) -> None:
        self.words, self.known = words, {}

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        import xxhash

        pieces = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        offsets = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        coded = pieces.flatten().dictionary_encode()
        values = coded.dictionary.to_pylist()
        with uncollected():
            hashes = list(map(self.known.get, values))
            fresh = [i for i, h in enumerate(hashes) if h is None]
            for i in fresh:
                hashes[i] = xxhash.xxh3_64_intdigest(values[i].encode())
            if len(self.known) < CACHED:
                self.known.update([(values[i], hashes[i]) for i in fresh if len(values[i]) < 100])
        codes = coded.indices.to_numpy()
        filled = np.array([v != "" for v in [*values, ""]])[codes]
        word = np.array([*hashes, 0], np.uint64)[codes][filled]
        ends = np.concatenate([[0], np.cumsum(filled)])[offsets]
        k = self.words
        wide = np.zeros(max(0, len(word) - k + 1), np.uint64)
        for i in range(k):
            wide += mixed(word[i : i + len(wide)] + salt(i))
        wide = mixed(wide)
        for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if end - start >= k:
                yield np.unique(wide[start : end - k + 1])
            elif end > start:  # too few words: the whole sequence is the one shingle
                few = sum((mixed(word[start + i : start + i + 1] + salt(i)) for i in range(end - start)), np.zeros(1, np.uint64))
                yield mixed(few + salt(1000 + end - start))
            else:
                yield np.zeros(0, np.uint64)


class Regions:
    """Keys on which similar sets agree. Sizes fall in classes; a set has keys of its own class and of the next one if its
    links reach that far, and two sets of which the larger is in class k meet in class k."""

    def __init__(self, similarity: Fraction) -> None:
        self.similarity = similarity
        self.ratio = float(1 / similarity)
        self.apart = float(2 * (1 - similarity) / (1 + similarity))  # differences of a link, as a share of the larger size
        self.tokens = 0.65 / self.apart
        agree = math.exp(-0.65) - math.exp(-self.tokens)
        self.enough = math.ceil(math.log(MISSED) / math.log(1 - agree))

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        n = len(tokens)
        place = math.log(n) / math.log(self.ratio)
        classes = {int(math.floor(p / WIDTH + 1e-9)) for p in (place, place + 1)}
        return np.concatenate([self._class(tokens, k) for k in sorted(classes)])

    def _class(self, tokens: np.ndarray, k: int) -> np.ndarray:
        n = len(tokens)
        most = math.ceil(self.ratio ** (WIDTH * (k + 1)) + 1e-6)
        differences = math.floor(self.apart * most + 1e-9)
        if not differences:
            return np.zeros(0, np.uint64)  # only equal sets link
        exact = differences + 1 + (differences + 4) // 4
        regions = exact if exact <= self.enough else math.ceil(most / self.tokens)
        used = min(regions, exact if exact <= self.enough else self.enough)
        region = (tokens >> np.uint64(32)) * np.uint64(regions) >> np.uint64(32)
        bounds = np.searchsorted(region, np.arange(used + 1, dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(tokens[: bounds[-1]] + salt(2000)), dtype=np.uint64)])
        content = sums[bounds[1:]] - sums[bounds[:-1]]
        filled = bounds[1:] > bounds[:-1]
        place = np.arange(used, dtype=np.uint64)[filled] + np.uint64((k + 1) << 32)
        keys = mixed(mixed(content[filled]) + mixed(place))
        if regions == exact and filled.sum() <= differences:
            # too many empty regions for certainty: also the tokens of which two such sets share at least one
            first = n - math.ceil(self.similarity * n) + 1
            keys = np.concatenate([keys, mixed(tokens[:first] + salt(3000 + k))])
        return keys


def parity(tokens: np.ndarray) -> bytes:
    """A bit for each value of the lowest bits of a token, two to four bits a token: whether an odd number of tokens has it."""
    width = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(words: np.ndarray, start: np.ndarray, width: np.ndarray, to: int) -> np.ndarray:
    """Parities of ``width`` words, which begin at ``start``, all brought down to ``to`` words."""
    out = np.zeros((len(start), to), np.uint64)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        out[at] = np.bitwise_xor.reduce(words[start[at, None] + np.arange(w)].reshape(len(at), -1, to), axis=1)
    return out


def _possible(similarity: tuple[int, int]):
    """Function of the sets of one pair of tiles of a key, or of several whole keys: sets that may link, enough of the pairs
    to connect all of them that are."""
    share, whole = similarity

    def may_link(differ: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return whole * (sizes - differ) >= share * (sizes + differ)

    def connected(bits: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Sets by size; each is compared with those that nothing is connected to so far."""
        rest, near = np.arange(len(n)), bits
        while len(rest):
            todo, rest, near = [rest[-1]], rest[:-1], near[:-1]
            while todo and len(rest):
                i = todo.pop()
                low, high = np.searchsorted(n[rest], [-(-share * n[i] // whole), whole * n[i] // share + 1])
                found = low + np.flatnonzero(may_link(np.bitwise_count(near[low:high] ^ bits[i]).sum(1, dtype=np.int64), n[rest[low:high]] + n[i]))
                if len(found):
                    yield i, rest[found]
                    todo += rest[found].tolist()
                    rest, near = np.delete(rest, found), np.delete(near, found, axis=0)

    def possible(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        key, sid, n = (rows.column(c).to_numpy() for c in ("key", "sid", "n"))
        order = np.lexsort([sid, n, key])
        again = np.zeros(len(order), bool)  # a set comes twice where several tasks have read its text
        again[1:] = (np.diff(key[order]) == 0) & (np.diff(sid[order]) == 0)
        order = order[~again]
        key, sid, n = key[order], sid[order], n[order]
        parities = pa.concat_arrays(rows.column("parity").cast(pa.binary()).chunks)
        ends = np.frombuffer(parities.buffers()[1], np.int32)[parities.offset : parities.offset + len(parities) + 1].astype(np.int64)
        words = np.frombuffer(parities.buffers()[2], np.uint8)[ends[0] : ends[-1]].view("<u8")
        start, width = ((ends[:-1] - ends[0]) // 8)[order], (np.diff(ends) // 8)[order]
        first = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0]))
        sets = np.diff(np.append(first, len(key)))
        least = np.repeat(np.minimum.reduceat(width, first), sets)
        few = np.repeat(sets <= FEW, sets)
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        for w in np.unique(least[few]):
            at = np.flatnonzero(few & (least == w))
            bits = folded(words, start[at], width[at], int(w))
            for apart in range(1, FEW):
                i = np.flatnonzero(key[at[:-apart]] == key[at[apart:]])
                if not len(i):
                    break
                x, y = at[i], at[i + apart]
                found = may_link(np.bitwise_count(bits[i] ^ bits[i + apart]).sum(1, dtype=np.int64), n[x] + n[y])
                a.append(sid[x[found]])
                b.append(sid[y[found]])
        for s, m in zip(first[sets > FEW], sets[sets > FEW], strict=True):
            at = np.arange(s, s + m)
            for i, found in connected(folded(words, start[at], width[at], int(least[s])), n[at]):
                a.append(np.full(len(found), sid[s + i]))
                b.append(sid[s + found])
        nothing = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([nothing, *a]), "b": np.concatenate([nothing, *b])})

    return possible


def candidates(known: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a, b``: sets that agree on a region and by their parities may link, enough of the pairs to connect all of these.

    A key that a very large number of sets has is cut into tiles, of which each two are a task's work.
    """
    meeting = known.select("sid", F.explode("keys").alias("key"))
    shared = meeting.groupBy("key").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low < high").select("key")
    shared = stored(shared, "shared-keys")  # read again, so that a skewed join can be split
    met = stored(meeting.join(shared.hint("shuffle_hash"), "key").select("key", "sid"), "meetings")
    drop_tables(shared)
    parities = known.where("parity is not null").groupBy("sid").agg(F.first("parity").alias("parity"), F.max("n").alias("n"))
    sets = met.join(parities, "sid")
    parts = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS)).alias("parts")
    large = stored(sets.groupBy("key").agg(parts).where("parts > 1"), "large-keys")  # one for BLOCK rows at most
    sets = sets.join(F.broadcast(large), "key", "left").withColumn("tile", F.pmod(F.xxhash64("sid"), F.col("parts")))
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1), lambda i: i != F.col("tile"))
    alone = F.col("parts").isNull()
    sets = sets.select("key", "sid", "n", "parity", "tile", alone.alias("alone"), F.explode(F.when(alone, F.array(F.lit(-1).cast("bigint"))).otherwise(others)).alias("other"))
    bundle = F.pmod(F.xxhash64("key"), F.lit(met.count() // BUNDLE + 1))
    sets = sets.select(
        "key",
        "sid",
        "n",
        "parity",
        F.when(F.col("alone"), bundle).otherwise(F.col("key")).alias("owner"),
        F.when(F.col("alone"), -1).otherwise(F.least("tile", "other")).alias("x"),
        F.when(F.col("alone"), -1).otherwise(F.greatest("tile", "other")).alias("y"),
    )
    found = stored(sets.groupBy("owner", "x", "y").applyInArrow(_possible(similarity), "a bigint, b bigint"), "possible-links")
    drop_tables(met, large)
    return found


class Tree:
    """Nodes over sets sorted by size: a range of places, sizes, bitmaps of tokens in any and in all sets, two children."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, start: int, end: int) -> None:
        self.start, self.end = start, end
        self.low, self.high = int(sizes[start]), int(sizes[end - 1])
        if end - start <= LEAF:
            self.children: list[Tree] = []
            self.any, self.all = np.bitwise_or.reduce(bits[start:end]), np.bitwise_and.reduce(bits[start:end])
        else:
            middle = (start + end) // 2
            self.children = [Tree(bits, sizes, start, middle), Tree(bits, sizes, middle, end)]
            a, b = self.children
            self.any, self.all = a.any | b.any, a.all & b.all


class Traversal:
    """Links between sets, as a spanning forest."""

    def __init__(self, sets: list[np.ndarray], similarity: Fraction) -> None:
        self.sets, self.similarity = sets, similarity
        self.least = float(similarity / (1 + similarity)) - 1e-12  # overlap of a link, as a share of both sizes
        self.sizes = np.array([len(s) for s in sets], np.int64)
        width = 1 << max(9, min(14, int(self.sizes.max(initial=1)).bit_length()))
        self.bits = np.zeros((len(sets), width // 64), np.uint64)
        for i, s in enumerate(sets):
            bit = s & np.uint64(width - 1)
            np.bitwise_or.at(self.bits[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        self.group = np.arange(len(sets))
        self.forest: list[tuple[int, int]] = []

    def tree(self, start: int, end: int) -> Tree:
        return Tree(self.bits, self.sizes, start, end)

    def join(self, x: Tree, y: Tree) -> None:
        if x.high < self.similarity * y.low or y.high < self.similarity * x.low:
            return
        overlap = min(x.high - int(np.bitwise_count(x.all & ~y.any).sum()), y.high - int(np.bitwise_count(y.all & ~x.any).sum()))
        if overlap < self.least * (x.low + y.low):
            return
        first = self.group[x.start]
        if (self.group[x.start : x.end] == first).all() and (self.group[y.start : y.end] == first).all():
            return
        if x is y and x.children:
            a, b = x.children
            self.join(a, a)
            self.join(b, b)
            self.join(a, b)
        elif x.children and (not y.children or x.end - x.start >= y.end - y.start):
            for child in x.children:
                self.join(child, y)
        elif y.children:
            for child in y.children:
                self.join(x, child)
        else:
            self._leaves(x, y)

    def _leaves(self, x: Tree, y: Tree) -> None:
        a, b = self.bits[x.start : x.end, None], self.bits[None, y.start : y.end]
        na, nb = self.sizes[x.start : x.end, None], self.sizes[None, y.start : y.end]
        overlap = np.minimum(na - np.bitwise_count(a & ~b).sum(-1), nb - np.bitwise_count(b & ~a).sum(-1))
        possible = overlap >= self.least * (na + nb)
        if x is y:
            possible &= np.arange(x.start, x.end)[:, None] < np.arange(y.start, y.end)
        for i, j in zip(*np.nonzero(possible), strict=True):
            self._compare(int(i) + x.start, int(j) + y.start)

    def _compare(self, i: int, j: int) -> None:
        if self.group[i] == self.group[j]:
            return
        both = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
        either = len(self.sets[i]) + len(self.sets[j]) - both
        if self.similarity.denominator * both >= self.similarity.numerator * either:
            self.forest.append((i, j))
            self.group[self.group == self.group[j]] = self.group[i]


def _joined(similarity: tuple[int, int]):
    """Function of the sets of one pair of tiles of a group, or of several whole groups: edges of a forest of their links."""

    def join(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        root, tile, sid = (rows.column(c).to_numpy() for c in ("root", "tile", "sid"))
        tokens, within = rows.column("tokens"), rows.column("within").to_pylist()
        sizes = rows.column("n").to_numpy()
        u: list[int] = []
        v: list[int] = []
        order = np.lexsort([sid, sizes, tile, root])
        again = np.zeros(len(order), bool)  # a set comes twice where its document's id does
        again[1:] = np.logical_and.reduce([np.diff(column[order]) == 0 for column in (root, tile, sid)])
        order = order[~again]
        cuts = np.flatnonzero(np.diff(root[order])) + 1
        for members in np.split(order, cuts):
            sets = [np.frombuffer(tokens[int(i)].as_py(), "<u8") for i in members]
            work = Traversal(sets, Fraction(*similarity))
            ids = sid[members]
            ends = [0, *(np.flatnonzero(np.diff(tile[members])) + 1).tolist(), len(members)]
            trees = [work.tree(s, e) for s, e in zip(ends, ends[1:], strict=False)]
            if len(trees) == 1 or within[members[0]]:
                work.join(trees[0], trees[0])
            if len(trees) > 1:
                work.join(trees[0], trees[1])
            u += ids[[i for i, _ in work.forest]].tolist()
            v += ids[[j for _, j in work.forest]].tolist()
        return pa.table({"a": pa.array(u, pa.int64()), "b": pa.array(v, pa.int64())})

    return join


def _identity(tokens: np.ndarray) -> int:
    total = mixed(tokens + salt(4000)).sum(dtype=np.uint64)
    return int(mixed(np.array([total], np.uint64) + np.uint64(len(tokens)))[0].astype(np.int64))


def _tiles(count: str, by: int) -> Column:
    """The tiles of the class of size that is ``by`` away, of which there are ``count``."""
    numbers = F.filter(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col(count) - 1, F.lit(0))), lambda i: i < F.col(count))
    return F.transform(numbers, lambda i: (F.col("class") + by) * CELL + i)


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable by links) of every row.

    Words are runs of characters other than ASCII white space, with A-Z in lower case. Two sets link when ``similarity``
    (a fraction) of their union is common. A text with fewer words than a shingle is one shingle; null, empty or blank
    text has none and links with nothing. Equal texts link whatever their number. Rows with the same id are rows of their
    own; a row with a null id links with nothing and has a null component. Other columns are left out; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    fraction = Fraction(*similarity)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    shingles = share(spark.sparkContext, Shingles(words))

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regions, seen, found = Regions(fraction), set(), shingles()
        for batch in batches:
            sizes, ids, keys, bits = [], [], [], []
            for run in slices(batch.column(1), SLICE):
                for tokens in found.sets(run):
                    sizes.append(len(tokens))
                    ids.append(_identity(tokens) if len(tokens) else None)
                    new = len(tokens) and ids[-1] not in seen
                    keys.append(regions.keys(tokens).view(np.int64) if new else np.zeros(0, np.int64))
                    bits.append(parity(tokens) if new else None)
                    if new and len(seen) < CACHED:
                        seen.add(ids[-1])
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), lists, pa.array(bits, pa.binary())], ["doc_id", "n", "sid", "keys", "parity"])
        hand_back_memory()

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = shingles()
        for batch in batches:
            for run in slices(batch.column(0), SLICE):
                found = [t for t in hashed.sets(run) if len(t)]
                yield pa.RecordBatch.from_arrays([pa.array([_identity(t) for t in found], pa.int64()), pa.array([len(t) for t in found], pa.int64()), pa.array([t.tobytes() for t in found], pa.binary())], ["sid", "n", "tokens"])
        hand_back_memory()

    known = stored(rows.mapInArrow(summarised, "doc_id bigint, n bigint, sid bigint, keys array<bigint>, parity binary"), "shingle-keys")
    with_id = known.where("doc_id is not null and sid is not null")
    possible = candidates(with_id, similarity)
    groups = stored(components(possible, "a", "b").withColumnRenamed("node", "sid"), "set-groups")
    drop_tables(possible)
    firsts = with_id.join(groups, "sid").groupBy("sid", "root").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    firsts = stored(firsts, "first-documents")
    documents = wanted = stored(firsts.select("doc_id").distinct(), "group-documents")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    sets = rows.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(fetched, "sid bigint, n bigint, tokens binary")
    total = groups.count()
    step = F.floor(F.log("n") / math.log(1 / fraction) + 1e-9)
    placed = firsts.select("sid", "root", step.alias("class"))
    classes = firsts.groupBy("root", step.alias("class")).agg(F.count("*").alias("sets"), F.sum("n").alias("tokens"))
    classes = classes.select("*", F.greatest(F.ceil(F.col("sets") / TILE), F.ceil(F.col("tokens") / TILE_TOKENS)).alias("parts"))
    group = Window.partitionBy("root")  # a row for each class of size, some dozens
    alone = (F.sum("sets").over(group) <= TILE) & (F.sum("tokens").over(group) <= TILE_TOKENS)
    near = Window.partitionBy("root").orderBy("class")
    beside = [F.when(other("class").over(near) == F.col("class") + by, other("parts").over(near)).otherwise(0) for other, by in ((F.lag, -1), (F.lead, 1))]
    classes = classes.select("root", "class", "parts", alone.alias("alone"), beside[0].alias("below"), beside[1].alias("above"))
    place = placed.join(classes, ["root", "class"]).withColumn("tile", F.col("class") * CELL + F.pmod(F.xxhash64("sid"), F.col("parts")))
    if total <= BROADCAST_ROWS:
        place = F.broadcast(place)  # the sets then move once, to their tiles
    sets = sets.join(place, "sid")
    # a tile meets the other tiles of its class and those of the classes beside; it meets itself where it meets the first tile
    # of the class above, or alone if there is none
    meets = F.concat(_tiles("below", -1), _tiles("parts", 0), _tiles("above", 1))
    meets = F.filter(meets, lambda cell: (cell != F.col("tile")) | (F.col("above") == 0))
    sets = sets.select("root", "tile", "alone", "sid", "n", "tokens", F.explode(F.when(F.col("alone"), F.array(F.lit(-1).cast("bigint"))).otherwise(meets)).alias("other"))
    # groups of one tile travel in bundles
    bundle = F.pmod(F.xxhash64("root"), F.lit(total // BUNDLE + 1))
    low, high = F.least("tile", "other"), F.greatest("tile", "other")
    within = (high % CELL == 0) & (F.floor(high / CELL) == F.floor(low / CELL) + 1)
    sets = sets.select(
        "root",
        "sid",
        "n",
        "tokens",
        F.when(F.col("alone"), 0).otherwise(F.col("tile")).alias("tile"),
        F.when(F.col("alone"), False).otherwise(within).alias("within"),
        F.when(F.col("alone"), -1).otherwise(low).alias("x"),
        F.when(F.col("alone"), -1).otherwise(high).alias("y"),
        F.when(F.col("alone"), bundle).otherwise(F.col("root")).alias("owner"),
    )
    links = stored(sets.groupBy("owner", "x", "y").applyInArrow(_joined(similarity), "a bigint, b bigint"), "set-links")
    drop_tables(groups, firsts, documents)
    roots = components(links, "a", "b").withColumnRenamed("node", "sid")
    smallest = with_id.groupBy("sid").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    smallest = smallest.join(roots, "sid", "left").where("copies > 1 or root is not null").withColumn("root", F.coalesce("root", "sid"))
    smallest = stored(smallest, "set-roots")
    least = stored(smallest.groupBy("root").agg(F.min("first").alias("component_id")), "smallest-ids")
    chosen = smallest.join(least, "root").select("sid", "component_id")
    out = known.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("sid")).alias("sid")).join(chosen, "sid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents of which 90 % of the three-word shingles are common."""
    return linked(table(spark, sf_dir, "documents"), words=3, similarity=(90, 100))


ship_with_tasks(__name__)
