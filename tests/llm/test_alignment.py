import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer

from stockloom.llm import op12_alignment as t
from stockloom.llm.bpe import byte_letters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "a  b", "a ", " a", "\n", "a\n b", "x<|endoftext|>y <s> </s> <0x41>", "naïve — 北京 😀 é ▁x", "a▁b c", "tab\tx  　y", "\x00 z\x00", "it's I'LL", "a" * 3000, "퟿ �﻿", "ﬁ ½ ＡＢ"]


def brute(rows):
    """The contract, token by token."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_letters()
    out, counts = [], Counter()
    for doc, text in rows:
        full = (" " + text).encode() if text else b""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != full or b"".join(bytes_b) != full:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            groups.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            i, j = x, y
        at_b = dict(zip(ends_b, ids_b, strict=True))
        links = [(p, at_b[e]) for p, e in zip(ids_a, ends_a, strict=True) if e in at_b]
        counts.update(links)
        out.append((doc, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    top = defaultdict(int)
    for (_, y), c in counts.items():
        top[y] = max(top[y], c)
    return sorted((str(doc), n, m, g, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), h) for doc, n, m, g, links, h in out)


def found(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def test_odd_texts(spark):
    rnd = random.Random(3)
    rows = [*enumerate(ODD), (None, "repeated row"), (7, "repeated row"), (7, "repeated row")]
    rows += [(100 + i, "".join(rnd.choice("ab \n\té.'’1▁") for _ in range(rnd.randint(1, 40)))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_a", "'x' as pairs", "2L as count")
    done = t.alignments(docs, A, B)
    assert found(t.with_counts(done, t.pair_counts(done))) == brute(rows)
    none = t.alignments(docs.limit(0), A, B)
    assert found(t.with_counts(none, t.pair_counts(none))) == []


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert found(t.op12_token_alignment(spark, folder)) == brute(rows)


def test_groups_and_overlaps():
    # "abcdef" as ab|c|def and abc|d|ef; then one unit on its own
    one = t.aligned(np.array([2, 1, 3, 1]), np.array([3, 1]), np.array([3, 1, 2, 1]), np.array([3, 1]))
    assert one.group_a.tolist() == [0, 2, 3, 4] and one.group_b.tolist() == [0, 1, 3, 4] and one.group_unit.tolist() == [0, 0, 1]
    pairs = list(zip(one.overlap_a.tolist(), one.overlap_b.tolist(), one.ends_together.tolist(), strict=True))
    assert pairs == [(0, 0, False), (1, 0, True), (2, 1, False), (2, 2, True), (3, 3, True)]


def test_slices_and_caches_change_nothing(monkeypatch):
    import pyarrow as pa

    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choice("abcdé.\n") for _ in range(rnd.randint(1, 9))) for _ in range(30)) for _ in range(60)]
    sources = open(A).read(), open(B, "rb").read()

    def run(cached, most):
        monkeypatch.setattr(t, "CACHED", cached)
        work = t.Pair(*sources)
        return [(*x, y.tolist()) for s in t.slices(pa.array(texts), most) for *x, y in work.texts(s)]

    assert run(0, 300) == run(10_000, 1 << 30)
