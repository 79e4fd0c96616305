"""Language identification by words first, then ever shorter character n-grams.

A known word counts with its log frequency in each language. An unseen word counts with the mean log frequency of its
n-grams of the largest length of which the model knows any. A text gets the language with the largest sum.

The model is fitted on a bounded sample of labelled rows (``max_docs``, drawn by key hash, whole texts) and keeps a
bounded number of words and n-grams of each language, so what is broadcast has a fixed size. Prediction is a column
function: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stockloom.llm.bpe import slices, uncollected
from stockloom.llm.common import stored, table
from stockloom.shipping import hand_back_memory, share, ship_with_tasks

MAX_DOCS, MAX_WORDS, MAX_GRAMS, GRAM = 20_000, 30_000, 20_000, 4
UNKNOWN = "und"
PARTS = 32
CACHED, SLICE, BLOCK = 80_000, 1_000_000, 10_000
WORD = re.compile(r"[^\W\d_]+")


def words_of(chunk: str) -> list[str]:
    """Lower-cased runs of letters."""
    low = chunk.lower()
    return [low] if low.isalpha() else [w for w in WORD.findall(low) if w.isalpha() or any(map(str.isalpha, w))]


def grams_of(word: str, n: int) -> list[str]:
    return [word[i : i + n] for i in range(len(word) - n + 1)]


class Grams:
    """Known n-grams as a tree of their letters, climbed from all places of many words at once.

    The nodes of a length are numbered by their key: the node of all letters but the last, and the last letter. Node 0 and
    letter 0 are unknown and lead nowhere.
    """

    def __init__(self, index: dict[int, dict[str, int]]) -> None:
        """``index``: by length, the row of each n-gram."""
        letters = sorted({c for n in range(1, GRAM + 1) for g in index[n] for c in g})
        self.letters = np.zeros(ord(letters[-1]) + 2 if letters else 1, np.int64)  # the last one: beyond all known letters
        self.letters[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        code = {c: i for i, c in enumerate(letters, 1)}
        nodes: dict[str, int] = dict(code)
        self.keys: dict[int, np.ndarray] = {}
        self.rows = {1: np.array([-1, *(index[1].get(c, -1) for c in letters)])}
        for n in range(2, GRAM + 1):
            starts = {g[:n] for k in range(n, GRAM + 1) for g in index[k]}
            found = sorted((nodes[g[:-1]] << 32 | code[g[-1]], g) for g in starts)
            self.keys[n] = np.array([-1, *(k for k, _ in found)], np.int64)
            self.rows[n] = np.array([-1, *(index[n].get(g, -1) for _, g in found)])
            nodes = {g: i for i, (_, g) in enumerate(found, 1)}

    def rows_of(self, words: list[str]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """The word that each place of all words belongs to, and by length the row of the n-gram that begins there, -1 if
        unknown. The place after a word belongs to it, too."""
        points = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), "<u4")  # no n-gram reaches across the zero
        letters = self.letters[np.minimum(points, len(self.letters) - 1)]
        node, rows = letters, {1: self.rows[1][letters]}
        for n in range(2, GRAM + 1):
            keys, key = self.keys[n], node[:-1] << 32 | letters[n - 1 :]
            at = np.searchsorted(keys, key)
            at[at == len(keys)] = 0
            node = np.where(keys[at] == key, at, 0)
            rows[n] = self.rows[n][node]
        return np.repeat(np.arange(len(words)), np.diff(np.flatnonzero(points == 0), prepend=-1)), rows


class Model:
    """Languages, and of each known word and n-gram its log frequencies in them."""

    def __init__(self, counts: list[tuple[str, int, str, int]], totals: list[tuple[str, int, int, int]]) -> None:
        """``counts``: language, length of the n-gram (0: word), string, count; ``totals``: the same without the string, as
        sum of all counts and number of strings."""
        self.languages = sorted({lang for lang, *_ in totals})
        column = {lang: i for i, lang in enumerate(self.languages)}
        size = {(lang, n): (total, kinds) for lang, n, total, kinds in totals}
        seen: dict[int, dict[str, int]] = {n: {} for n in range(GRAM + 1)}
        for _, n, s, _ in counts:
            seen[n].setdefault(s, len(seen[n]))
        self.words, self.grams, self.table, self.met = seen[0], Grams(seen), {}, {}
        for n, index in seen.items():
            found = np.zeros((len(index), len(self.languages)))
            for lang, k, s, c in counts:
                if k == n:
                    found[index[s], column[lang]] = c
            sums = [size.get((lang, n), (0, 0)) for lang in self.languages]
            total = np.array([t + 0.5 * (kinds + 1) for t, kinds in sums])
            self.table[n] = np.log((found + 0.5) / total) if len(index) else found
            self.met[n] = found > 0


class Identifier:
    """Sums of the log frequencies of texts; chunks between white space are remembered with the sum of their words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.rows: dict[str, int] = {}
        self.sums = np.zeros((1024, 2 * len(model.languages) + 1))

    def identify(self, texts: pa.Array) -> Iterator[tuple[str, float]]:
        return ((lang, score) for lang, score, _ in self.assess(texts))

    def assess(self, texts: pa.Array) -> Iterator[tuple[str, float, float]]:
        """Language, share of the likelihood, and how much of the text is known in that language: the mean over its words of
        1 for a word seen there, else the share of its n-grams of the largest length seen there."""
        pieces = pc.utf8_split_whitespace(texts)
        offsets = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        coded = pieces.flatten().dictionary_encode()
        with uncollected():
            chunks = coded.dictionary.to_pylist()
            rows = list(map(self.rows.get, chunks))
            places = [i for i, r in enumerate(rows) if r is None]
            known, need = len(self.rows), len(self.rows) + len(places)
            if need > len(self.sums):
                self.sums = np.concatenate([self.sums[:known], np.zeros((max(need, 2 * known) - known, self.sums.shape[1]))])
            self.sums[known:need] = self._sums([chunks[i] for i in places])
            for r, i in enumerate(places, known):
                rows[i] = r
            if need <= CACHED:
                self.rows.update([(chunks[i], rows[i]) for i in places])
        each = self.sums[np.array([*rows, 0])[coded.indices.to_numpy()]]
        totals = np.zeros((len(texts), self.sums.shape[1]))
        filled = np.flatnonzero(np.diff(offsets))
        if len(filled):
            totals[filled] = np.add.reduceat(each, offsets[filled], axis=0)
        width = len(self.model.languages)
        total, n, known = totals[:, :width], totals[:, width], totals[:, width + 1 :]
        told = np.flatnonzero(n)
        langs, scores, shares = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        if len(told):
            total, n, known = total[told], n[told], known[told]
            every, best = np.arange(len(told)), total.argmax(axis=1)
            scale = np.minimum(n, 20.0) / n
            scores[told] = 1 / np.exp((total - total[every, best][:, None]) * scale[:, None]).sum(axis=1)
            shares[told] = known[every, best] / n
            for i, lang in zip(told.tolist(), best.tolist(), strict=True):
                langs[i] = self.model.languages[lang]
        return zip(langs, scores.tolist(), shares.tolist(), strict=True)

    def _sums(self, chunks: list[str]) -> np.ndarray:
        words = [words_of(c) for c in chunks]
        rows: dict[str, int] = {}
        at = [rows.setdefault(w, len(rows)) for found in words for w in found]
        distinct = list(rows)
        width = len(self.model.languages)
        out = np.zeros((len(chunks), self.sums.shape[1]))
        if not distinct or not width:
            return out
        rated = np.concatenate([self._rated(distinct[i : i + BLOCK]) for i in range(0, len(distinct), BLOCK)])
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        filled = np.flatnonzero(sizes)
        sums = np.add.reduceat(rated[at], (np.cumsum(sizes) - sizes)[filled], axis=0)
        out[filled, :width], out[filled, width], out[filled, width + 1 :] = sums[:, :width], sizes[filled], sums[:, width:]
        return out

    def _rated(self, words: list[str]) -> np.ndarray:
        """Of each word its log frequencies, and how much of it is known, in each language."""
        model, width = self.model, len(self.model.languages)
        out = np.zeros((len(words), 2 * width))
        scores, known = out[:, :width], out[:, width:]
        whole = np.array([-1 if (r := model.words.get(w)) is None else r for w in words])
        owners, rows = model.grams.rows_of(words)
        unseen = whole < 0
        for n in range(GRAM, 0, -1):
            hit = rows[n] >= 0
            if n < GRAM:
                hit &= unseen[owners[: len(hit)]]
            places = np.flatnonzero(hit)
            if not len(places):
                continue
            mine, flat = owners[places], rows[n][places]
            starts = np.flatnonzero(np.diff(mine, prepend=-1))
            mine, hits = mine[starts], np.diff(starts, append=len(flat))
            if n == GRAM:
                every = np.bincount(owners)[mine] - GRAM  # n-grams of the word, known or not
                known[mine] = np.add.reduceat(model.met[n][flat].astype(float), starts, axis=0) / every[:, None]
            now = unseen[mine]
            scores[mine[now]] = (np.add.reduceat(model.table[n][flat], starts, axis=0) / hits[:, None])[now]
            unseen[mine] = False
        seen = np.flatnonzero(whole >= 0)
        scores[seen] = model.table[0][whole[seen]]
        known[seen] = np.maximum(known[seen], model.met[0][whole[seen]])
        return out


def fitted(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", max_docs: int = MAX_DOCS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """The model of the labelled rows of ``docs``; rows with null text or language are left out.

    About ``max_docs`` rows take part: all if there are no more, otherwise those whose key hash is small enough. Of each
    language the ``max_words`` most frequent words and the ``max_grams`` most frequent n-grams of each length are kept.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    n = rows.count()
    if n > max_docs:
        rows = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.lit(int(max_docs / n * (1 << 30))))
    words = rows.select("lang", "text").mapInArrow(_word_counts, "lang string, s string, c bigint").groupBy("lang", "s").agg(F.sum("c").alias("c"))
    words = stored(words, "language-words")
    grams = words.mapInArrow(_gram_counts, "lang string, n int, s string, c bigint").groupBy("lang", "n", "s").agg(F.sum("c").alias("c"))
    counts = stored(words.select("lang", F.lit(0).alias("n"), "s", "c").unionByName(grams), "language-counts")
    totals = counts.groupBy("lang", "n").agg(F.sum("c").alias("total"), F.count("*").alias("kinds")).toArrow().to_pylist()
    # the most frequent of each part first, so that no task ranks all strings of a language
    most = F.when(F.col("n") == 0, max_words).otherwise(max_grams)
    order = [F.desc("c"), "s"]
    part = Window.partitionBy("lang", "n", F.pmod(F.xxhash64("s"), F.lit(PARTS))).orderBy(*order)
    best = counts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= most)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "n").orderBy(*order))).where(F.col("rank") <= most)
    kept = best.select("lang", "n", "s", "c").toArrow().to_pylist()
    return Model([(r["lang"], r["n"], r["s"], r["c"]) for r in kept], [(r["lang"], r["n"], r["total"], r["kinds"]) for r in totals])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words in one task, by language; handed on whenever they have become many."""
    counts: dict[str, Counter] = {}

    def out() -> pa.RecordBatch:
        words: Counter = Counter()
        for lang, chunks in counts.items():
            for chunk, c in chunks.items():
                for w in words_of(chunk):
                    words[lang, w] += c
        counts.clear()
        rows = list(words.items())
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.int64())], ["lang", "s", "c"])

    for batch in batches:
        for i in range(batch.num_rows):
            counts.setdefault(batch.column(0)[i].as_py(), Counter()).update(batch.column(1)[i].as_py().split())
            if sum(map(len, counts.values())) > 100_000:
                yield out()
    if counts:
        yield out()
    hand_back_memory()


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams of words that are counted already."""
    for batch in batches:
        for start in range(0, batch.num_rows, 5000):
            part, grams = batch.slice(start, 5000), Counter()
            for lang, w, c in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                for n in range(1, GRAM + 1):
                    for g in grams_of(w, n):
                        grams[lang, n, g] += c
            rows = list(grams.items())
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()), pa.array([k[2] for k, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.int64())], ["lang", "n", "s", "c"])
    hand_back_memory()


def language_udf(spark: SparkSession, model: Model):
    """UDF: text to struct(lang, score, known)."""
    shared = share(spark.sparkContext, Identifier(model))

    @F.arrow_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("known", T.DoubleType())]))
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        identifier = shared()
        for batch in batches:
            found = [x for run in slices(batch, SLICE) for x in identifier.assess(run)]
            yield pa.StructArray.from_arrays([pa.array([x for x, _, _ in found], pa.string()), pa.array([s for _, s, _ in found], pa.float64()), pa.array([k for _, _, k in found], pa.float64())], ["lang", "score", "known"])
        hand_back_memory()

    return predict


def predicted(docs: DataFrame, model: Model, text: str | Column = "text", lang: str = "lang_pred", score: str = "score", known: str | None = None) -> DataFrame:
    """``docs`` with the predicted language and its share of the likelihood (0 to 1).

    ``und`` with score 0 for null, empty or letterless text, and for every text if the model has seen no labelled row.
    Ties go to the language that comes first in the alphabet. All columns and rows are kept; columns named as the new ones
    are replaced. ``known`` names a column for the known share of the text (0 to 1), which doesn't depend on the number of
    languages learned.
    """
    found = language_udf(docs.sparkSession, model)(text)
    return docs.withColumn("_found", found).withColumns({lang: F.col("_found.lang"), score: F.col("_found.score")} | ({known: F.col("_found.known")} if known else {})).drop("_found")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fitted(docs.where(~held_out()))
    return predicted(docs.select("doc_id", "text", held_out().alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


ship_with_tasks(__name__)
