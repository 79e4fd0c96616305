import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stockloom.llm.op4_packing import Packer, WordIds, op4_packing, pack_examples, pack_texts

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "A  b", "It's I'LL", "<|startoftext|> a <|endoftext|>b", "é É É ß ẞ Σ ΑΣ İ", "\x1c a\x1db", "x" * 3000, "漢字 かな 1234 ²", "a  b c\n\t\vd"]


def test_ids_equal_the_library():
    encoder, library = WordIds(open(FILE).read()), Tokenizer.from_file(FILE)
    for _ in range(2):
        flat, ends = encoder.encode(pa.array(ODD, pa.large_string()))
        for text, a, b in zip(ODD, ends, ends[1:], strict=False):
            assert flat[a:b].tolist() == library.encode(text, add_special_tokens=False).ids


def check(pieces, wanted, most=2048):
    """Pieces cover every example without overlap, and sequences without gaps."""
    cover, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        cover[p.doc_id].append((p.start, p.length, p.doc_tokens))
        sequences[p.sequence_id].append((p.offset, p.length))
    assert {k: sum(x[1] for x in v) for k, v in cover.items()} == {k: n for k, n in wanted.items()}
    for v in cover.values():
        at = 0
        for start, length, _ in sorted(v):
            assert start == at and length > 0
            at += length
    lengths = []
    for v in sequences.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= most
        lengths.append(at)
    return lengths


def test_documents(spark, tmp_path):
    rows = [*enumerate(ODD), (100, None), (101, "word " * 10_000), (102, "word " * 10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as length", "'x' as ids")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(FILE)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    found = op4_packing(spark, str(tmp_path)).collect()
    lengths = check(found, {i: len(x) for i, x in ids.items()})
    assert all(n & (n - 1) == 0 for n in lengths)
    for p in found:
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()) and p.doc_tokens == len(ids[p.doc_id])
    for p in pack_texts(docs, FILE).collect():
        assert p.ids == ids[p.doc_id][p.start : p.start + p.length]
    assert pack_texts(docs.limit(0), FILE).count() == 0


def test_three_limits():
    rng = np.random.default_rng(0)
    packer = Packer(1000, 8, 300, False, 0)
    examples = {i: (rng.integers(1, 700), rng.random()) for i in range(3000)}
    pieces, need = [], np.zeros(3)
    for i, (n, share) in examples.items():
        loss = (rng.random(n) < share * 0.4).astype(int)
        need += [n, 1, loss.sum()]
        pieces += packer.add(i, np.arange(n, dtype="<u4"), loss)
    pieces += packer.end()
    sums = defaultdict(lambda: np.zeros(3))
    for key, _, ids, loss, sequence, _, _ in pieces:
        sums[sequence] += [len(ids), 1, loss]
    assert all((s <= [1000, 8, 300]).all() for s in sums.values())
    assert sum(len(p[2]) for p in pieces) == need[0]
    assert len(sums) < 1.15 * (need / [1000, 8, 300]).max() + 1


def test_examples(spark):
    rows = [(1, [5, 6, 7], [True, None, True]), (2, None, None), (3, [], []), (4, list(range(40)), None), (5, [1, 2], [True])]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>, loss array<boolean>")
    found = pack_examples(frame, "doc_id", "ids", "loss", max_tokens=16, max_loss=16).collect()
    check(found, {1: 3, 4: 40, 5: 2}, 16)
    assert {p.doc_id: p.n_loss for p in found if p.doc_id in (1, 5)} == {1: 2, 5: 1}


@pytest.mark.parametrize("sf", ["0.001"])
def test_given_documents(spark, sf):
    found = op4_packing(spark, f"/root/testdata/sf{sf}").collect()
    library = Tokenizer.from_file(FILE)
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").collect()
    lengths = check(found, {d.doc_id: len(library.encode(d.text or "", add_special_tokens=False).ids) + 1 for d in docs})
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths) <= 0.01 * sum(lengths)
