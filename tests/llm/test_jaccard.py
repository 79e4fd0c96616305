import random
import re

import pytest

from stockloom.llm.op8_jaccard import linked, op8_jaccard_join


def shingles(text, k):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def brute_force(rows, k, share):
    sets = [shingles(t, k) if i is not None else set() for i, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and share[1] * len(a & b) >= share[0] * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for i, (key, t) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if group[j] == group[i]]
        out.append((key, len(shingles(t, k)), key if len(members) == 1 else min(members)))
    return sorted(out, key=str)


def check(spark, rows, k, share):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as sid", "'y' as root")
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in linked(docs, words=k, similarity=share).collect()]
    assert sorted(found, key=str) == brute_force(rows, k, share)


@pytest.mark.parametrize(("k", "share"), [(3, (90, 100)), (5, (80, 100)), (1, (1, 2))])
def test_against_all_pairs(spark, k, share):
    rnd = random.Random(k)
    rows, base = [], []
    for length in (4, 9, 14, 25, 40, 80, 300, 900):
        for _ in range(3):
            base.append([f"w{rnd.randint(0, 5000)}" for _ in range(length)])
    for words in base:
        for _ in range(9):
            copy = list(words)
            for _ in range(rnd.randint(0, max(1, len(copy) // 12))):
                at = rnd.randrange(len(copy))
                if rnd.random() < 0.5:
                    copy[at] = f"x{rnd.randint(0, 10**6)}"
                elif len(copy) > 2:
                    del copy[at : at + rnd.randint(1, 2)]
            rows.append((len(rows), " ".join(copy)))
    rnd.shuffle(rows)
    check(spark, rows, k, share)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "one\x0btwo"), (8, "É a b c"), (9, "é a b c"), (10, "a b c"), (10, "a b c"), (None, "a b c"), (11, "a " * 30_000), (12, "A  " * 200), (13, "b a " * 100)]
    check(spark, rows, 3, (90, 100))
    assert linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_group_of_near_copies(spark):
    """More sets than a tile holds, all alike."""
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*words, f"z{i}"])) for i in range(1300)]
    found = linked(spark.createDataFrame(rows, "doc_id long, text string"), words=3, similarity=(90, 100)).collect()
    assert len(found) == 1300 and {r.component_id for r in found} == {0}


@pytest.mark.parametrize("tile, tokens", [(3, 10**9), (10**9, 60)])
def test_groups_of_many_tiles(spark, monkeypatch, tile, tokens):
    from stockloom.llm import op8_jaccard

    monkeypatch.setattr(op8_jaccard, "TILE", tile)
    monkeypatch.setattr(op8_jaccard, "TILE_TOKENS", tokens)
    rnd = random.Random(4)
    words = [rnd.choice("abcdefghij") + str(i) for i in range(30)]
    rows = [(i, " ".join(w if rnd.random() > 0.03 else "x" for w in words)) for i in range(40)]
    check(spark, rows, 3, (80, 100))


@pytest.mark.parametrize("tile", [2, 5, 10**9])
def test_chain_over_many_classes_of_size(spark, monkeypatch, tile):
    """Prefixes of one text: each links with the next few only, and with sets of the class above."""
    from stockloom.llm import op8_jaccard

    monkeypatch.setattr(op8_jaccard, "TILE", tile)
    words = [f"w{i}" for i in range(130)]
    rows = [(n, " ".join(words[:n])) for n in (5, 8, 10, 11, 13, 16, 20, 24, 29, 35, 42, 52, 70, 84, 101, 120, 130)]
    rows += [(1000 + i, " ".join([*words[:40], *(f"z{i}{j}" for j in range(60))])) for i in range(12)]
    check(spark, rows, 3, (80, 100))


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in op8_jaccard_join(spark, folder).collect()]
    assert sorted(found, key=str) == brute_force(rows, 3, (90, 100))


def test_common_passages_make_no_groups(spark, monkeypatch):
    """Texts that share a passage agree on regions, but are too different to be compared; copies still meet."""
    from stockloom.llm import op8_jaccard

    kept = {}

    def keep(df, name, stored=op8_jaccard.stored):
        kept[name] = stored(df, name)
        return kept[name]

    monkeypatch.setattr(op8_jaccard, "stored", keep)
    monkeypatch.setattr(op8_jaccard, "drop_tables", lambda *tables: None, raising=False)
    rnd = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([*passage, *(f"w{rnd.randint(0, 10**9)}" for _ in range(rnd.randint(60, 160)))])) for i in range(300)]
    rows += [(1000 + i, t + " end") for i, t in rows[:20]]
    check(spark, rows, 5, (80, 100))
    assert kept["set-groups"].count() <= 60


@pytest.mark.parametrize("block, tokens, few", [(3, 10**9, 2), (10**9, 400, 16), (10**9, 10**9, 2)])
def test_keys_of_many_tiles(spark, monkeypatch, block, tokens, few):
    from stockloom.llm import op8_jaccard

    monkeypatch.setattr(op8_jaccard, "BLOCK", block)
    monkeypatch.setattr(op8_jaccard, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(op8_jaccard, "FEW", few)
    rnd = random.Random(5)
    words = [rnd.choice("abcdefghij") + str(i) for i in range(120)]
    rows = [(i, " ".join(w if rnd.random() > 0.015 else f"x{rnd.randint(0, 99)}" for w in words[: rnd.randint(85, 120)])) for i in range(60)]
    check(spark, rows, 3, (80, 100))


def test_parities_never_differ_more_than_tokens():
    import numpy as np

    from stockloom.llm.op8_jaccard import folded, parity

    rnd = np.random.default_rng(3)
    for n in (1, 2, 31, 33, 64, 500, 3000):
        a = np.unique(rnd.integers(0, 2**64, n, np.uint64))
        for gone, new in ((0, 0), (n // 20, n // 15), (n, n // 2)):
            b = np.unique(np.concatenate([a[gone:], rnd.integers(0, 2**64, new, np.uint64)]))
            bits = [np.frombuffer(parity(x), "<u8") for x in (a, b)]
            width = np.array([len(x) for x in bits])
            both = folded(np.concatenate(bits), np.array([0, width[0]]), width, int(width.min()))
            differ = int(np.bitwise_count(both[0] ^ both[1]).sum())
            assert differ <= gone + new and (differ - len(a) - len(b)) % 2 == 0
            assert differ > 0 or gone + new < 3
