"""Packing by vector bin packing.

Examples go to sequences under three limits at once: tokens, segments, and tokens that bear loss. A sequence is filled by
the dot-product rule: of the examples that still fit, the one whose demand has the largest product with what is left of
the limits, each limit weighted by its mean demand. Where none fits, an example is cut to fill the rest (``cut``).

Each task packs the rows it reads, in windows of bounded size, and hands what didn't fill a sequence on to its next
window, so nothing is shuffled and no row waits for another task. At the end of a task a last sequence stays unfilled; it
is cut into sequences whose lengths are powers of two, which need no padding. Sequence numbers hold the task's number in
their upper bits; a task that runs again packs alike.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from stockloom.llm.bpe import BLANK, WordEncoder, slices, spread
from stockloom.llm.common import table
from stockloom.shipping import hand_back_memory, share, ship_with_tasks

MAX_TOKENS, MAX_SEGMENTS, END = 2048, 256, 1
WINDOW_ITEMS, WINDOW_TOKENS = 1024, 4_000_000
PLAIN_CHUNK = "[!-;=-~À-ÖØ-öø-ÿ]+"  # lower-cased and normalised character by character; "<" may open a special token


class WordIds(WordEncoder):
    """Ids of texts whose tokenizer drops white space: chunks between white space are encoded alike wherever they stand."""

    def __init__(self, source: str) -> None:
        import regex

        super().__init__(source)
        self.source, self.library = source, None
        self.rule = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{BLANK}\p{{L}}\p{{N}}]+")
        self.plain = re.compile(PLAIN_CHUNK)
        self.chunks: dict[str, bytes] = {}

    def words_of(self, chunk: str) -> list[str]:
        low = chunk.lower()
        return [low] if low.isalpha() else self.rule.findall(low)

    def learn(self, chunks: Iterable[str]) -> dict[str, bytes]:
        chunks = list(chunks)
        plain = [c for c in chunks if self.plain.fullmatch(c)]
        fresh = super().learn(plain)
        if len(fresh) < len(chunks):
            fresh |= {c: self._by_library(c) for c in chunks if c not in fresh}
        return fresh

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text begins."""
        pieces = pc.ascii_split_whitespace(texts)
        offsets = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        coded = pieces.flatten().dictionary_encode()
        ids = self.ids_of(coded.dictionary.to_pylist(), self.chunks)
        flat, ends = spread(ids, coded.indices.to_numpy().astype(np.int64), 4)
        return flat, ends[offsets]

    def _by_library(self, chunk: str) -> bytes:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.source)
            self.library.no_truncation()
            self.library.no_padding()
        return np.array(self.library.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()


class Packer:
    """Takes examples, gives pieces: key, start, ids, tokens that bear loss, sequence, offset, tokens of the example."""

    def __init__(self, tokens: int, segments: int, loss: int, cut: bool, first_sequence: int) -> None:
        self.limits = np.array([tokens, segments, loss], np.float64)
        self.tokens, self.cut, self.sequence = tokens, cut, first_sequence
        self.items: list[tuple] = []  # key, ids, loss before each id (None: every id bears loss), start, end
        self.held = 0

    def add(self, key, ids: np.ndarray, loss: np.ndarray | None = None) -> Iterator[tuple]:
        before = None if loss is None else np.concatenate([[0], np.cumsum(loss)])
        start = 0
        while len(ids) - start >= self.tokens or self._loss(before, start, len(ids)) > self.limits[2]:
            end = self._reach(before, start, len(ids), self.tokens, self.limits[2])
            yield from self._sequence([(key, ids, before, start, end)])
            start = end
        if start < len(ids):
            self.items.append((key, ids, before, start, len(ids)))
            self.held += len(ids) - start
        if len(self.items) >= WINDOW_ITEMS or self.held >= WINDOW_TOKENS:
            yield from self._fill()

    def end(self) -> Iterator[tuple]:
        yield from self._fill()
        while self.items:
            yield from self._fill(last=True)

    @staticmethod
    def _loss(before, start: int, end: int) -> int:
        return end - start if before is None else int(before[end] - before[start])

    @staticmethod
    def _reach(before, start: int, end: int, tokens: int, loss: float) -> int:
        """End of the longest piece from ``start`` within both limits."""
        end = min(end, start + int(tokens))
        if before is None:
            return min(end, start + int(loss))
        return min(end, int(np.searchsorted(before, before[start] + loss, side="right")) - 1)

    def _fill(self, last: bool = False) -> Iterator[tuple]:
        items = self.items
        demand = np.array([[e - s, 1, self._loss(b, s, e)] for _, _, b, s, e in items], np.float64).reshape(-1, 3) / self.limits
        weight = demand.mean(axis=0) if len(items) else np.ones(3)
        free = np.ones(len(items), bool)
        left = demand.sum(axis=0)
        while free.any() and (last or left.max() >= 1):
            room, chosen = np.ones(3), []
            while True:
                fits = free & (demand <= room + 1e-9).all(axis=1)
                if not fits.any():
                    break
                i = int(np.where(fits, demand @ (weight * room), -1.0).argmax())
                chosen.append(items[i])
                free[i] = False
                room, left = room - demand[i], left - demand[i]
            rest = np.rint(room * self.limits)
            if self.cut and free.any() and rest.min() >= 1:
                i = int(np.where(free, demand[:, 0], -1.0).argmax())
                key, ids, before, start, end = items[i]
                at = self._reach(before, start, end, rest[0], rest[2])
                if at > start:
                    chosen.append((key, ids, before, start, at))
                    items[i] = (key, ids, before, at, end)
                    now = np.array([end - at, 1, self._loss(before, at, end)]) / self.limits
                    left, demand[i] = left - demand[i] + now, now
            yield from self._sequence(chosen)
        self.items = [x for x, keep in zip(items, free, strict=True) if keep]
        self.held = sum(x[4] - x[3] for x in self.items)

    def _sequence(self, chosen: list[tuple]) -> Iterator[tuple]:
        """One sequence; if it isn't full and may be cut, one for each binary digit of its length."""
        size = sum(x[4] - x[3] for x in chosen)
        sizes = [size]
        if self.cut and size < self.tokens:
            sizes = [1 << k for k in reversed(range(size.bit_length())) if size >> k & 1]
        room, offset = sizes[0], 0
        left = iter(sizes[1:])
        for key, ids, before, start, end in chosen:
            while start < end:
                if offset == room:
                    self.sequence, room, offset = self.sequence + 1, next(left), 0
                to = min(end, start + room - offset)
                yield key, start, ids[start:to], self._loss(before, start, to), self.sequence, offset, len(ids)
                offset += to - start
                start = to
        self.sequence += 1


def _number(first: int) -> int:
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() << 33) + first


def pack_texts(docs: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, end_id: int = END, output: str = "ids") -> DataFrame:
    """Pieces of all texts, each text's ids followed by ``end_id``; every token bears loss.

    ``output``: "ids" gives the ids of a piece, "crc32" the checksum of their little-endian 32-bit form in their place.
    Null text counts as empty (one piece that holds the end id); rows with the same or a null ``doc_id`` are examples of
    their own; other columns are left out; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    model = share(spark.sparkContext, WordIds(Path(tokenizer_file).read_text()))
    column = ("ids", pa.list_(pa.int32())) if output == "ids" else ("ids_crc32", pa.int64())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model()
        packer = Packer(max_tokens, max_segments, max_tokens, True, _number(0))

        def examples():
            for batch in batches:
                keys = iter(batch.column(0).to_pylist())
                for run in slices(batch.column(1)):
                    flat, ends = encoder.encode(run)
                    for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                        yield next(keys), np.append(flat[start:end], np.uint32(end_id))

        yield from _batches(examples(), packer, column, pa.int64())
        hand_back_memory()

    kind = docs.schema[doc_id].dataType.simpleString()
    if kind != "bigint":
        docs = docs.withColumn(doc_id, docs[doc_id].cast("bigint"))
    sql = "array<int>" if output == "ids" else "bigint"
    return docs.select(doc_id, text).mapInArrow(pack, f"{doc_id} bigint, start bigint, length bigint, {column[0]} {sql}, n_loss bigint, doc_tokens bigint, sequence_id bigint, offset bigint")


def pack_examples(examples: DataFrame, key: str, ids: str, loss: str | None = None, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, cut: bool = False) -> DataFrame:
    """Pieces of instruction examples: ``ids`` an array of token ids, ``loss`` an array of booleans beside it.

    Without ``cut`` an example is cut only if it is longer than a sequence. Null or empty ``ids`` give no piece; a null
    ``loss``: every token bears loss; missing or null flags: no loss. ``key`` must be a bigint.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(max_tokens, max_segments, max_loss or max_tokens, cut, _number(0))

        def rows():
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    flags = part.column(2).to_pylist() if loss else [None] * part.num_rows
                    for k, x, f in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), flags, strict=True):
                        if x:
                            yield k, np.array(x, "<u4"), None if f is None else np.array([bool(b) for b in [*f, *[False] * len(x)][: len(x)]], np.int64)

        yield from _batches(rows(), packer, ("ids", pa.list_(pa.int32())), pa.int64())

    return examples.select(key, ids, *([loss] if loss else [])).mapInArrow(pack, f"{key} bigint, start bigint, length bigint, ids array<int>, n_loss bigint, doc_tokens bigint, sequence_id bigint, offset bigint")


def _batches(examples: Iterator[tuple], packer: Packer, column: tuple[str, pa.DataType], key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    as_digest = column[0] == "ids_crc32"
    held: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        key, start, ids, n_loss, sequence, offset, total = zip(*held, strict=True)
        values = pa.array([zlib.crc32(x) if as_digest else x.view("<i4") for x in ids], column[1])
        wide = [pa.array(x, pa.int64()) for x in (start, list(map(len, ids)))]
        rest = [pa.array(x, pa.int64()) for x in (n_loss, total, sequence, offset)]
        return pa.RecordBatch.from_arrays([pa.array(key, key_type), *wide, values, *rest], ["key", "start", "length", column[0], "n_loss", "doc_tokens", "sequence_id", "offset"])

    def pieces():
        for example in examples:
            yield from packer.add(*example)
        yield from packer.end()

    for piece in pieces():
        held.append(piece)
        size += len(piece[2])
        if size >= 250_000 or len(held) >= 10_000:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    pieces = pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"), output="crc32")
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


ship_with_tasks(__name__)
