"""Byte-pair encoding with a contiguous rank array, for many short words at once.

A word is an array of parts. Beside it lies the array of the ranks of its adjacent parts. Again and again the smallest
rank is looked up, the boundary between its two parts is deleted, and the ranks of the two neighbours are refreshed. Words
of about the same length share one matrix, so each of these steps is one NumPy operation for all of them. Words longer
than ``SHORT`` parts take the same merges in the same order from a heap, because scanning a long array is quadratic.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stockloom.shipping import ship_with_tasks

SHORT = 48
NEVER = np.int32(2**31 - 1)
CACHED = 120_000  # encodings a Python worker keeps of each kind; what comes later is encoded anew for each slice of texts


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary files (fixed by the file format)."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Ranks and results of all merges, first parts of a word, and the bytes of each id; made from a tokenizer file."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        vocab, letters = model["vocab"], byte_letters()
        suffix = model.get("end_of_word_suffix") or ""
        found = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            found.append((vocab[left] << 32 | vocab[right], rank, vocab[left + right]))
        found.sort()
        self.keys = np.array([k for k, _, _ in found], dtype=np.int64)
        self.ranks = np.array([r for _, r, _ in found], dtype=np.int32)
        self.merged = np.array([m for _, _, m in found], dtype=np.int32)
        self.inner = np.zeros(256, np.int32)
        self.final = np.zeros(256, np.int32)
        for letter, byte in letters.items():
            self.inner[byte] = vocab[letter]
            self.final[byte] = vocab[letter + suffix]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        if not suffix:
            for token, i in vocab.items():
                self.pieces[i] = bytes(letters[c] for c in token)
            for token, i in self.special.items():
                self.pieces[i] = token.encode()

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of the merge of each pair, -1 without one."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, -1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            n = len(w)
            if n > SHORT:
                out[i] = self._long(w)
            elif n:
                by_length.setdefault((n + 3) // 4 * 4, []).append(i)
        for width, members in by_length.items():
            for start in range(0, len(members), 20_000):
                part = members[start : start + 20_000]
                for i, ids in zip(part, self._short([words[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _first_parts(self, word: bytes) -> np.ndarray:
        raw = np.frombuffer(word, np.uint8)
        ids = self.inner[raw]
        ids[-1] = self.final[raw[-1]]
        return ids

    def _short(self, words: list[bytes], width: int) -> list[bytes]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        every = np.arange(len(words))
        ids = self.inner[raw]
        ids[every, size - 1] = self.final[raw[every, size - 1]]
        column = np.arange(width)
        merge = self.look_up(ids[:, :-1], ids[:, 1:])
        rank = np.where((merge >= 0) & (column[1:] < size[:, None]), self.ranks[merge], NEVER)
        kept, left_over = np.zeros((len(words), width), "<u4"), np.zeros(len(words), np.int64)
        while len(every):
            at = rank.argmin(axis=1)
            row = np.arange(len(every))
            ended = rank[row, at] == NEVER
            if ended.any():
                kept[every[ended]], left_over[every[ended]] = ids[ended], size[ended]
                going = ~ended
                every, ids, rank, size, at = every[going], ids[going], rank[going], size[going], at[going]
                row = np.arange(len(every))
                if not len(every):
                    break
            new = self.merged[self.look_up(ids[row, at], ids[row, at + 1])]
            ids[row, at] = new
            size = size - 1
            ids = np.take_along_axis(ids, np.minimum(column + (column > at[:, None]), width - 1), 1)  # the boundary goes
            gap = column[:-1] + (column[:-1] > at[:, None])
            rank = np.where(gap < width - 1, np.take_along_axis(rank, np.minimum(gap, width - 2), 1), NEVER)
            before, after = np.maximum(at - 1, 0), np.minimum(at + 1, width - 1)
            left = self.look_up(ids[row, before], new)
            right = self.look_up(new, ids[row, after])
            has_left, has_right = at > 0, at + 1 < size
            rank[row[has_left], before[has_left]] = np.where(left >= 0, self.ranks[left], NEVER)[has_left]
            inside = at < width - 1
            rank[row[inside], at[inside]] = np.where((right >= 0) & has_right, self.ranks[right], NEVER)[inside]
        flat, step = kept.tobytes(), 4 * width
        return [flat[i * step : i * step + 4 * n] for i, n in enumerate(left_over.tolist())]

    def _long(self, word: bytes) -> bytes:
        ids = self._first_parts(word).tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        merge = self.look_up(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(int(self.ranks[m]), i, ids[i], ids[i + 1], m) for i, m in enumerate(merge) if m >= 0]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, m = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != left or ids[j] != right:
                continue
            ids[i], alive[j], after[i] = int(self.merged[m]), False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    m = int(self.look_up(np.array([ids[a]]), np.array([ids[b]]))[0])
                    if m >= 0:
                        heapq.heappush(heap, (int(self.ranks[m]), a, ids[a], ids[b], m))
        return np.array([x for x, ok in zip(ids, alive, strict=True) if ok], "<u4").tobytes()


#: White space as the tokenizer files mean it.
BLANK = "\t-\r \x85\xa0  -     　"


def spread(values: list[bytes], codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of ``codes`` one after the other, as little-endian numbers of ``width`` bytes, and where each begins."""
    kind = np.dtype(f"<u{width}")
    size = np.fromiter(map(len, values), np.int64, len(values)) // width
    return gathered(np.frombuffer(b"".join(values), kind), size, codes)


def gathered(base: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``spread``, for values that lie end to end in ``base``; a part of the codes is worked on at a time."""
    start = np.cumsum(size) - size
    ends = np.concatenate([[0], np.cumsum(size[codes])])
    out = np.empty(ends[-1], base.dtype)
    for at in range(0, len(codes), 250_000):
        part = codes[at : at + 250_000]
        first, n = ends[at], size[part]
        length = int(n.sum())
        out[first : first + length] = base[np.repeat(start[part] - (np.cumsum(n) - n), n) + np.arange(length)]
    return out, ends


def slices(texts: pa.Array, most: int = 4_000_000) -> Iterator[pa.Array]:
    """Runs of texts of about ``most`` bytes in all, nulls as empty texts; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        # a copy: some kernels read a slice, or what is cast from one, from the beginning of its buffer
        yield pc.fill_null(texts.take(pa.array(np.arange(start, end))), "").cast(pa.large_string())
        start = end


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for cycles meanwhile: it would walk all remembered encodings again and again."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


class WordEncoder:
    """Ids of words and of chunks (words that stand together), remembered from batch to batch and task to task.

    An encoder is shared with the workers; a reused worker keeps it, and with it what has been learned.
    """

    def __init__(self, source: str) -> None:
        self.merges = Merges(source)
        self.known: dict[str, bytes] = {}  # by word

    def words_of(self, chunk: str) -> list[str]:
        raise NotImplementedError

    def learn(self, chunks: Iterable[str]) -> dict[str, bytes]:
        """Ids of chunks."""
        known, fresh = self.known, {}
        whole, mixed, words = [], [], set()
        for c in chunks:
            found = self.words_of(c)
            if len(found) == 1:
                word = found[0]
                ids = known.get(word)
                if ids is None:
                    words.add(word)
                    whole.append((c, word))
                else:
                    fresh[c] = ids
            else:
                words.update(found)
                mixed.append((c, found))
        unseen = list(words - known.keys())
        new = dict(zip(unseen, self.merges.encode([w.encode() for w in unseen]), strict=True))
        for c, word in whole:
            fresh[c] = new[word]
        for c, found in mixed:
            fresh[c] = b"".join([new[w] if w in new else known[w] for w in found])
        if len(known) < CACHED:
            known.update(new)
        return fresh

    def ids_of(self, chunks: list[str], kept: dict[str, bytes], lead: str = "") -> list[bytes]:
        """Ids of each chunk with ``lead`` before it, looked up in ``kept`` or learned."""
        with uncollected():
            ids = list(map(kept.get, chunks))
            if None in ids:
                places = [i for i, x in enumerate(ids) if x is None]
                fresh = self.learn({lead + chunks[i] for i in places})
                for i in places:
                    ids[i] = fresh[lead + chunks[i]]
                if len(kept) < CACHED:
                    kept.update([(chunks[i], ids[i]) for i in places if len(chunks[i]) < 100])
            return ids


class TextEncoder(WordEncoder):
    """Byte-level tokenizers: a word begins with the space before it.

    A chunk is a space and what follows up to the next one; it is encoded alike wherever it stands. Texts in which white
    space meets a space, or that hold a special token, are cut into words by the full rule.
    """

    def __init__(self, source: str) -> None:
        import regex

        super().__init__(source)
        self.rule = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
        )
        special = "|".join(map(re.escape, sorted(self.merges.special, key=len, reverse=True)))
        self.special = re.compile(f"({special})") if special else None
        self.by_rule = rf" [{BLANK}]| $|^ " + (f"|{special}" if special else "")
        self.spaced: dict[str, bytes] = {}  # by chunk without its space
        self.plain: dict[str, bytes] = {}  # by chunk that has none

    def words_of(self, chunk: str) -> list[str]:
        return [chunk] if chunk.isalpha() or chunk[:1] == " " and chunk[1:].isalpha() else self.rule.findall(chunk)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text begins."""
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.by_rule).to_numpy(zero_copy_only=False))
        whole = texts if not len(odd) else pc.if_else(pc.match_substring_regex(texts, self.by_rule), "", texts)
        pieces = pc.split_pattern(whole, " ")
        offsets = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        coded = pieces.flatten().dictionary_encode()
        values = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy().astype(np.int64)
        firsts = [values[i] for i in codes[offsets[:-1]]]
        codes[offsets[:-1]] = len(values) + np.arange(len(firsts))
        ids = self.ids_of(values, self.spaced, " ") + self.ids_of(firsts, self.plain)
        for i in odd.tolist():
            ids[len(values) + i] = self._by_rule(texts[i].as_py())
        flat, ends = spread(ids, codes, 4)
        return flat, ends[offsets]

    def _by_rule(self, text: str) -> bytes:
        out = []
        for piece in self.special.split(text) if self.special else [text]:
            if piece in self.merges.special:
                out.append(self.merges.special[piece].to_bytes(4, "little"))
            else:
                out += self.ids_of(self.rule.findall(piece), self.plain)
        return b"".join(out)


ship_with_tasks(__name__)
