"""Spelling variants grouped by dense prefix-suffix tiling.

Words are counted over the whole corpus; the vocabulary of frequent words is compared with itself. Two words are one edit
apart exactly if common prefix and common suffix together reach the longer length minus one. One of the two then reaches
half of that, so it is enough to compare words that agree on the first or on the last half: these are the tiles, one set
for each length of the longer word. A tile of any size is cut into blocks of at most about ``BLOCK`` words, and every pair
of blocks of a tile is a task's unit of work: two padded matrices of code points are compared, the common prefix and
suffix of all their pairs are counted at once.

No word meets the whole vocabulary, no tile has to fit into a task, and only pairs that are near leave a task. Forms and
roots come from grouped minima and from doubling steps over a table of (word, form).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm.common import shuffle_parts, stored, table
from stockloom.shipping import ship_with_tasks

LETTERS, LEAST, RATIO, TYPO = 6, 5, 5, 199
BLOCK = 512  # words of a tile that are compared with as many others at a time
MATRIX = 4_000_000  # code points of the pairs compared at a time
HELD = 300_000  # distinct words a task counts before it hands them on
SIDE = re.compile("[<>]")
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")  # [A-Za-zÀ-ÿ]+ in UTF-8, with A-Z in lower case


# --- counting -----------------------------------------------------------------------------------------------------


def misspelt(prefix: int, word: bytes) -> str:
    """The word, or without one code point if the hash of document and word says so."""
    h = zlib.crc32(word, prefix)
    text = word.decode()
    if h % TYPO == 0:
        at = h % len(text)
        text = text[:at] + text[at + 1 :]
    return text


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = LETTERS, least: int = LEAST) -> DataFrame:
    """``word, n``: words of at least ``letters`` code points that occur ``least`` times in all texts.

    Null and empty texts have no words; repeated rows count each time; a null id hashes as an empty one. Texts are read
    whole, one after the other; what a task has counted is added up before it is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            words = [w for w in held if len(w) >= letters]
            found = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], ["word", "n"])
            held.clear()
            return found

        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py()
                if not raw:
                    continue
                key = batch.column(0)[i].as_py()
                prefix = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(RUN.findall(raw.encode().lower())).items():
                    if zlib.crc32(word, prefix) % TYPO:
                        held[word.decode()] += n
                    else:
                        held[misspelt(prefix, word)] += n
                if len(held) >= HELD:
                    yield out()
        if held:
            yield out()

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


# --- tiles --------------------------------------------------------------------------------------------------------


def tiled(words: DataFrame) -> DataFrame:
    """``tile, long, word, n``: each word in the tiles of its own length and of one more.

    ``tile`` names the longer length of its pairs, the side and the half that its words agree on; ``long`` tells whether
    the word has this length.
    """
    size = F.char_length("word")
    half = lambda longest: F.ceil((longest - 1) / 2).cast("int")

    def two(longest, long: bool):
        k = half(longest)
        start = F.concat(longest.cast("string"), F.lit("<"), F.left("word", k))
        end = F.concat(longest.cast("string"), F.lit(">"), F.right("word", k))
        return [F.struct(start.alias("tile"), F.lit(long).alias("long")), F.struct(end.alias("tile"), F.lit(long).alias("long"))]

    return words.select(F.inline(F.array(*two(size, True), *two(size + 1, False))), "word", "n")


def blocked(tiles: DataFrame, block: int = BLOCK) -> DataFrame:
    """Words of a tile with their block, once for each pair of blocks: ``tile, x, y, block, long, word, n``.

    Tiles without a word of the longer length, or with a single word, have no pairs and are left out.
    """
    sizes = tiles.groupBy("tile").agg(F.count("*").alias("members"), F.count_if("long").alias("longs")).where("members > 1 and longs > 0")
    sizes = stored(sizes.select(F.col("tile").alias("of"), F.ceil(F.col("members") / block).cast("int").alias("blocks")), "spelling-tiles")
    placed = tiles.join(sizes, F.col("tile") == F.col("of")).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = placed.withColumn("other", other)
    return pairs.select("tile", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "long", "word", "n")


class Matrix:
    """Code points of words, padded with zeros: from the front and from the back."""

    def __init__(self, words: list[str]) -> None:
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        width = int(self.size.max(initial=1))
        self.front = np.array(words, dtype=f"<U{width}").view("<u4").reshape(-1, width)
        self.back = np.array([w[::-1] for w in words], dtype=f"<U{width}").view("<u4").reshape(-1, width)


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows; padding ends it by the shorter length, which the caller applies."""
    differs = a != b
    return np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])


def near_pairs(words: Matrix, i: np.ndarray, j: np.ndarray, front: np.ndarray) -> np.ndarray:
    """Which of the pairs are one edit apart; pairs of a suffix tile only if no prefix tile has them.

    ``i`` holds the longer word of each pair. Equal words are not near.
    """
    longest, shortest = words.size[i], words.size[j]
    prefix = np.minimum(common(words.front[i], words.front[j]), shortest)
    suffix = np.minimum(common(words.back[i], words.back[j]), shortest)
    near = (prefix + suffix >= longest - 1) & ~((longest == shortest) & (prefix == longest))
    return near & (front | (prefix < (longest - 1 + 1) // 2))


def pairs_within(starts: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places i < j of each run of rows, about ``most`` at a time."""
    each = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(starts, sizes) + place
    after = sizes[each] - 1 - place
    ends = np.cumsum(after)
    at = 0
    while at < len(row):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        n = after[at:to]
        left = np.repeat(row[at:to], n)
        yield left, left + 1 + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
        at = to


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs in rows sorted by tile and pair of blocks; a pair of blocks may go on in the next batch."""
    schema = ["a", "n_a", "b", "n_b"]
    rest: pa.Table | None = None

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tile = rows.column("tile").combine_chunks().dictionary_encode()
        code = tile.indices.to_numpy().astype(np.int64)
        names = tile.dictionary.to_pylist()
        in_front = np.array([SIDE.search(t)[0] == "<" for t in names], bool)
        length = np.array([int(SIDE.split(t, maxsplit=1)[0]) for t in names])[code]
        for each in np.unique(length):  # words of one length at a time: a long word doesn't widen the matrix of all
            part = np.flatnonzero(length == each)
            yield from compare(rows.take(pa.array(part)), code[part], in_front, int(each))

    def compare(rows: pa.Table, code: np.ndarray, in_front: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
        x, y, block, long, n = (rows.column(c).to_numpy() for c in ("x", "y", "block", "long", "n"))
        words = rows.column("word").to_pylist()
        matrix = Matrix(words)
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(code)))
        for i, j in pairs_within(starts, sizes, max(1000, MATRIX // length)):
            # two words of one block meet where the block meets itself; two shorter ones meet in the tile of their own length
            keep = (long[i] | long[j]) & ((block[i] != block[j]) | (x[i] == y[i]))
            i, j = i[keep], j[keep]
            swap = ~long[i]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            near = near_pairs(matrix, i, j, in_front[code[i]])
            i, j = i[near], j[near]
            if len(i):
                a, b = [words[k] for k in i.tolist()], [words[k] for k in j.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(a + b, pa.string()), pa.array(np.concatenate([n[i], n[j]])), pa.array(b + a, pa.string()), pa.array(np.concatenate([n[j], n[i]]))], schema)

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None and len(rest):
            rows = pa.concat_tables([rest, rows])
        if not len(rows):
            continue
        last = {c: rows.column(c)[-1].as_py() for c in ("tile", "x", "y")}
        size = 0
        while size < len(rows) and all(rows.column(c)[len(rows) - 1 - size].as_py() == v for c, v in last.items()):
            size += 1
        rest = rows.slice(len(rows) - size).combine_chunks()
        if size < len(rows):
            yield from work(rows.slice(0, len(rows) - size))
    if rest is not None and len(rest):
        yield from work(rest)


# --- variants -----------------------------------------------------------------------------------------------------


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, n_a, b, n_b``: every pair of words one edit apart, in both directions. ``words`` has distinct ``word, n``."""
    parts = shuffle_parts(words.sparkSession)
    rows = blocked(tiled(words), block).repartition(parts, "tile", "x", "y").sortWithinPartitions("tile", "x", "y")
    return rows.mapInArrow(_compared, "a string, n_a bigint, b string, n_b bigint")


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the distinct ``word, n`` of ``words``.

    A form is the near word of largest count (ties: the first in code-point order), if that is at least ``ratio`` times
    the word's own; the root follows forms to the last. Counts grow along forms, so there are no circles, and a chain of k
    forms takes log2 k joins. An empty vocabulary gives no rows; other columns are left out.
    """
    words = stored(words.select("word", "n"), "spelling-words")
    first = F.min(F.struct((-F.col("n_b")).alias("rank"), F.col("b").alias("word")))
    found = near_words(words, block).groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), first.alias("best"))
    known = words.join(found, "word", "left").withColumn("takes", -F.col("best.rank") >= ratio * F.col("n"))
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(F.col("takes"), F.col("best.word")).alias("form"), F.when(F.col("takes"), -F.col("best.rank")).alias("form_n"))
    known = stored(known, "spelling-forms")
    steps = known.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("next"), F.col("root").alias("beyond"))
        moved = steps.join(ahead, F.col("root") == F.col("next"), "left")
        moved = stored(moved.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("went_on")), "spelling-roots")
        steps = moved.select("word", "root")
        if moved.where("went_on").isEmpty():
            break
    out = known.join(steps, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their likely correct forms."""
    return variants(word_counts(table(spark, sf_dir, "documents")))


ship_with_tasks(__name__)
