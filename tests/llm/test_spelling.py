import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from stockloom.llm import op11_spelling as s


def count(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def shapes(w):
    """All that is left of a word without one code point, and with a hole in place of one."""
    return {("cut", w[:i] + w[i + 1 :]) for i in range(len(w))} | {("hole", i, w[:i] + w[i + 1 :]) for i in range(len(w))} | {("cut", w)}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    by_shape = defaultdict(set)
    for w in words:
        for x in shapes(w):
            by_shape[x].add(w)
    out = {}
    for w, n in words.items():
        near = {v for x in shapes(w) for v in by_shape[x] if v != w and one_edit(w, v)}
        form = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = [form if form and words[form] >= 5 * n else None, n, len(near)]
    roots = {}
    for w in words:
        root = w
        while out[root][0]:
            root = out[root][0]
        roots[w] = root
    return sorted((w, f or "", roots[w], n, near, words[f] if f else -1) for w, (f, n, near) in out.items())


def found(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def test_counting(spark):
    rnd = random.Random(1)
    rows = [(i % 40, " ".join(rnd.choice(["Éclair", "éclairs", "WORDS×÷ab", "ordinary", "Ordinary-ordinary", "short", "ÿÿÿÿÿÿ", "naïveté", "Straße's", "日本ordinary"]) for _ in range(60))) for i in range(300)]
    rows += [(None, "Ordinary Ordinary"), (None, None), (3, ""), (3, rows[3][1]), (3, rows[3][1]), (9, "longest " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n")
    assert {r.word: r.n for r in s.word_counts(docs).collect()} == count(rows)
    assert s.variants(s.word_counts(docs.limit(0))).count() == 0
    # the condition for deletions holds for some of these words, so that they are tested
    assert any(zlib.crc32(f"{d}:ordinary".encode()) % 199 == 0 for d, _ in rows) or any(len(w) == 7 for w in count(rows))


def test_variants_equal_brute_force(spark):
    rnd = random.Random(2)
    words = {}
    while len(words) < 1500:
        w = "".join(rnd.choice("abé") for _ in range(rnd.randint(6, 9)))
        words[w] = rnd.choice([5, 6, 25, 26, 130, 700, 4000])
    base = "internationalisation" * 20  # long words
    words |= {base: 500, base[:-1]: 5, "x" + base: 5, base[:200] + "q" + base[201:]: 99, "ſtart" * 2: 1}
    words.pop("ſtart" * 2)
    df = spark.createDataFrame([*words.items()], "word string, n long").selectExpr("*", "1 as tile", "2 as root")
    for block in (7, 512):  # tiles of many blocks, and of one
        assert found(s.variants(df, block=block)) == brute(words)


def test_chain_of_forms(spark):
    words = {"abcdef" + "g" * i: 5**(i + 1) for i in range(9)}
    df = spark.createDataFrame([*words.items()], "word string, n long")
    assert {r.root for r in s.variants(df).collect()} == {"abcdefgggggggg"}


def test_near_pairs_of_all_short_words():
    from itertools import product

    words = ["".join(x) for n in (3, 4) for x in product("ab", repeat=n)]
    m = s.Matrix(words)
    i, j = (np.array(x) for x in zip(*[(a, b) for a in range(len(words)) for b in range(len(words)) if a != b and len(words[a]) >= len(words[b])], strict=True))
    near = s.near_pairs(m, i, j, np.ones(len(i), bool))
    assert near.tolist() == [one_edit(words[a], words[b]) for a, b in zip(i, j, strict=True)]


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert found(s.op11_spelling_variants(spark, folder)) == brute(count(rows))
