"""Alignment of two tokenizers by interval coalescing.

The tokens of both tokenizers are byte intervals over the same bytes. All intervals are sorted by their start; a running
maximum of the ends goes along, and a group breaks where a start reaches it. Inside a group the overlapping pairs of
tokens are expanded: each stretch between two neighbouring ends lies in one token of either side.

A unit is a space and what follows up to the next one. Both tokenizers treat it alike wherever it stands, so all groups of
a text end with its units, and each distinct unit is aligned once for a whole slice of texts. Texts in which white space
meets a space are units as a whole. The first pass writes one row a text: its figures and its distinct linked id pairs.
Their counts over the corpus are summed from that table; the ids are fixed by the vocabularies and the shorter token of a
link is a suffix of the longer, which bounds the number of pairs by the bytes of both vocabularies (here about 800,000),
and with it what is broadcast to the second pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm.bpe import BLANK, TextEncoder, gathered, slices
from stockloom.llm.common import stored, table
from stockloom.shipping import share, ship_with_tasks

CACHED, SLICE = 60_000, 2_000_000  # units a worker keeps; bytes of text worked on at a time
WHOLE = rf" [{BLANK}]| $|^ "  # texts that hold this are one unit
B_BITS = 32  # a pair is the id of A above these bits and the id of B in them


@dataclass
class Alignment:
    """Groups and overlaps of many units; ``unit`` counts them, tokens are numbered through."""

    group_unit: np.ndarray  # unit of each group
    group_a: np.ndarray  # first token of A of each group, and the number of tokens at the end
    group_b: np.ndarray
    overlap_a: np.ndarray  # overlapping pairs of tokens
    overlap_b: np.ndarray
    overlap_unit: np.ndarray
    ends_together: np.ndarray  # whether the two tokens of an overlap end at the same byte


def aligned(size_a: np.ndarray, n_a: np.ndarray, size_b: np.ndarray, n_b: np.ndarray) -> Alignment:
    """Coalesce the tokens of many units: byte lengths of all tokens, and tokens of each unit, of both tokenizers.

    The tokens of a unit cover the same bytes in both; all of them have at least one byte.
    """
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    start = np.concatenate([end_a - size_a, end_b - size_b])
    end = np.concatenate([end_a, end_b])
    side = np.repeat([0, 1], [len(size_a), len(size_b)])
    order = np.lexsort([side, start])
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.cumsum(breaks) - 1
    groups = int(group[-1]) + 1 if len(group) else 0
    count_a = np.bincount(group[side[order] == 0], minlength=groups)
    count_b = np.bincount(group[side[order] == 1], minlength=groups)
    # overlaps: every distinct end closes a stretch that lies in one token of each side
    ends, inverse = np.unique(end, return_inverse=True)
    at_a, at_b = np.zeros(len(ends), bool), np.zeros(len(ends), bool)
    at_a[inverse[: len(end_a)]] = True
    at_b[inverse[len(end_a) :]] = True
    overlap_a = np.cumsum(at_a) - at_a
    overlap_b = np.cumsum(at_b) - at_b
    unit_a = np.repeat(np.arange(len(n_a)), n_a)
    first_a = np.concatenate([[0], np.cumsum(count_a)])
    return Alignment(unit_a[first_a[:-1]], first_a, np.concatenate([[0], np.cumsum(count_b)]), overlap_a, overlap_b, unit_a[overlap_a], at_a & at_b)


class Spaced(TextEncoder):
    """The byte-level encoder for units, with the strings of special tokens as plain text."""

    def __init__(self, source: str) -> None:
        super().__init__(source)
        self.special, self.by_rule = None, WHOLE


class Pair:
    """Both tokenizers, and what has been learned about units: n_a, n_b, n_groups, text of the groups, links."""

    def __init__(self, tokenizer: str, model: bytes) -> None:
        self.a, self.model, self.library = Spaced(tokenizer), model, None
        self.size_a = np.array([len(x) for x in self.a.merges.pieces])
        self.bytes_a = np.frombuffer(b"".join(self.a.merges.pieces), np.uint8)
        self.units: dict[str, tuple] = {}

    def _load(self) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        pieces = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_b = np.array([len(x) for x in pieces])
        self.bytes_b = np.frombuffer(b"".join(pieces), np.uint8)

    def learn(self, units: list[str]) -> list[tuple]:
        """Figures of units, each of which begins with its space; without tokens for units whose bytes differ."""
        if self.library is None:
            self._load()
        found_a = [np.frombuffer(x, "<u4") for x in self.a.ids_of(units, {})]
        found_b = self.library.encode([u[1:] for u in units], num_threads=1)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (found_a, found_b))
        ids_a = np.concatenate([np.zeros(0, np.uint32), *found_a]).astype(np.int64)
        ids_b = np.fromiter((i for x in found_b for i in x), np.int64, int(n_b.sum()))
        raw = np.frombuffer("".join(units).encode(), np.uint8)
        n_raw = np.fromiter((len(u.encode()) for u in units), np.int64, len(units))
        good = self._same(ids_a, n_a, self.size_a, self.bytes_a, raw, n_raw) & self._same(ids_b, n_b, self.size_b, self.bytes_b, raw, n_raw)
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        n_a, n_b = n_a[good], n_b[good]
        found = aligned(self.size_a[ids_a], n_a, self.size_b[ids_b], n_b)
        texts = self._texts(found, ids_a, ids_b)
        together = found.ends_together
        links = ids_a[found.overlap_a[together]] << B_BITS | ids_b[found.overlap_b[together]]
        groups = np.bincount(found.group_unit, minlength=len(n_a))
        ends = np.cumsum(groups).tolist()
        link_ends = np.cumsum(np.bincount(found.overlap_unit[together], minlength=len(n_a))).tolist()
        out: list[tuple] = [(0, 0, 0, None, b"")] * len(units)
        g = k = 0
        for i, a, b, ge, ke in zip(np.flatnonzero(good).tolist(), n_a.tolist(), n_b.tolist(), ends, link_ends, strict=True):
            out[i] = (a, b, ge - g, ";".join(texts[g:ge]), links[k:ke].tobytes())
            g, k = ge, ke
        return out

    @staticmethod
    def _same(ids: np.ndarray, n: np.ndarray, size: np.ndarray, pieces: np.ndarray, raw: np.ndarray, n_raw: np.ndarray) -> np.ndarray:
        """Which units have tokens whose bytes are the unit's."""
        flat, ends = gathered(pieces, size, ids)
        lengths = np.diff(ends[np.concatenate([[0], np.cumsum(n)])])
        same = lengths == n_raw
        fits_flat, fits_raw = np.repeat(same, lengths), np.repeat(same, n_raw)
        unit = np.repeat(np.arange(len(n)), n_raw)[fits_raw]
        same[unit[flat[fits_flat] != raw[fits_raw]]] = False
        return same

    @staticmethod
    def _texts(found: Alignment, ids_a: np.ndarray, ids_b: np.ndarray) -> list[str]:
        """``a1,a2|b1`` of each group."""
        a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        first_a, first_b = found.group_a.tolist(), found.group_b.tolist()
        return [f"{','.join(a[i:j])}|{','.join(b[k:m])}" for i, j, k, m in zip(first_a, first_a[1:], first_b, first_b[1:], strict=False)]

    def facts_of(self, units: list[str]) -> list[tuple]:
        facts = list(map(self.units.get, units))
        fresh = [i for i, x in enumerate(facts) if x is None]
        if fresh:
            for i, x in zip(fresh, self.learn([units[i] for i in fresh]), strict=True):
                facts[i] = x
            if len(self.units) < CACHED:
                self.units.update((units[i], facts[i]) for i in fresh if len(units[i]) < 40)
        return facts

    def texts(self, run: pa.Array) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """n_a, n_b, n_groups, digest of the groups and links of each text; zeros, '' and nothing without tokens."""
        whole = pc.match_substring_regex(run, WHOLE).to_numpy(zero_copy_only=False)
        pieces = pc.split_pattern(pc.if_else(pa.array(whole), "", run), " ")
        coded = pieces.flatten().dictionary_encode()
        values = coded.dictionary.to_pylist()
        facts = self.facts_of([" " + v for v in values])
        codes = coded.indices.to_numpy()
        counts = np.array([x[:3] for x in facts], np.int64).reshape(-1, 3)
        bad = np.array([x[3] is None for x in facts], bool)
        offsets = (pieces.offsets.to_numpy() - pieces.offsets[0].as_py()).tolist()
        empty = (pc.binary_length(run).to_numpy(zero_copy_only=False) == 0).tolist()
        for i, (start, end) in enumerate(zip(offsets, offsets[1:], strict=False)):
            part = codes[start:end]
            if whole[i]:
                used = self.learn([" " + run[i].as_py()])
                figures, failed = np.array([used[0][:3]]), used[0][3] is None
            else:
                figures, failed = counts[part], bool(bad[part].any())
            if empty[i] or failed:
                yield 0, 0, 0, "", np.zeros(0, np.int64)
                continue
            if not whole[i]:
                used = [facts[c] for c in part.tolist()]
            n_a, n_b, n_groups = figures.sum(axis=0).tolist()
            digest = hashlib.sha256(";".join([x[3] for x in used]).encode()).hexdigest()
            yield n_a, n_b, n_groups, digest, np.frombuffer(b"".join([x[4] for x in used]), np.int64)


def alignments(docs: DataFrame, tokenizer_file: str, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a text: ``doc_id, n_a, n_b, n_groups, groups_sha256, n_links, pairs, times``.

    ``pairs`` are the distinct linked id pairs (A's id times 2^32 plus B's), ``times`` how often each is linked. Texts that
    are null or empty, or that one of the tokenizers doesn't give back byte by byte, have zeros, '' and no pairs. Every
    row stands for itself, repeated or null ids too; other columns are left out; an empty table gives no rows.
    """
    pair = share(docs.sparkSession.sparkContext, Pair(Path(tokenizer_file).read_text(), Path(model_file).read_bytes()))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = pair()
        for batch in batches:
            done = 0
            for run in slices(batch.column(1), SLICE):
                rows, links = [], []
                for *figures, found in work.texts(run):
                    links.append(np.unique(found, return_counts=True))
                    rows.append((*figures, len(found)))
                n_a, n_b, n_groups, digests, n_links = zip(*rows, strict=True)
                ends = pa.array(np.concatenate([[0], np.cumsum([len(p) for p, _ in links])]).astype(np.int32))
                pairs = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([p for p, _ in links])))
                times = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([t for _, t in links]).astype(np.int32)))
                ids = batch.column(0).slice(done, len(run))
                done += len(run)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)], pa.array(digests, pa.string()), pa.array(n_links, pa.int64()), pairs, times], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "pairs", "times"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(align, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_links bigint, pairs array<bigint>, times array<int>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, count, best``: links of each id pair in the whole corpus, and whether none of its B id has more."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new = np.concatenate([pairs, batch.column(0).flatten().to_numpy()])
            weight = np.concatenate([counts, batch.column(1).flatten().to_numpy()])
            pairs, place = np.unique(new, return_inverse=True)
            counts = np.bincount(place, weights=weight, minlength=len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "count"])

    counts = rows.select("pairs", "times").mapInArrow(summed, "pair bigint, count bigint").groupBy("pair").agg(F.sum("count").alias("count"))
    counts = stored(counts, "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    return counts.join(highest, b == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


class PairTable:
    """Counts by pair, sorted; its size is bounded by the vocabularies."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> None:
        order = np.argsort(pairs)
        self.pairs, self.counts, self.best = pairs[order], counts[order], best[order]


def with_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows of :func:`alignments` with ``n_best`` (links whose pair is the most frequent of its B id, ties too) and
    ``count_sum`` (the pairs' counts over all links) in place of the pairs."""
    found = counts.toArrow()
    known = PairTable(*[found.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "count", "best")])
    shared = share(rows.sparkSession.sparkContext, known)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared()
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            ends = pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
            at = np.searchsorted(table.pairs, pairs.flatten().to_numpy())
            best = np.concatenate([[0], np.cumsum(times * table.best[at])])
            total = np.concatenate([[0], np.cumsum(times * table.counts[at])])
            names = [n for n in batch.schema.names if n not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(best[ends[1:]] - best[ends[:-1]]), pa.array(total[ends[1:]] - total[ends[:-1]])], [*names, "n_best", "count_sum"])

    return rows.mapInArrow(look_up, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_links bigint, n_best bigint, count_sum bigint")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers for every whole text of ``documents``."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    rows = stored(alignments(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")), "alignments")
    return with_counts(rows, pair_counts(rows)).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


ship_with_tasks(__name__)
