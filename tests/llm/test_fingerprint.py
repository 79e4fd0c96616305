import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stockloom.llm.op2_fingerprint import combined, fingerprints, likeness, op2_fingerprint


def lanes(spark, rows):
    return {r.k: r for r in fingerprints(spark.createDataFrame(rows, "k int, text string"), ["k"]).collect()}


def test_order_independent_and_homomorphic(spark):
    found = lanes(spark, [(1, "a b c\nd e\nd e"), (2, "d e\na b c\nd e"), (3, "a b c\nd e"), (4, "d e"), (5, None), (6, ""), (7, "a b c"), (7, "d e")])
    assert found[1].equal == found[2].equal and found[1].alike == found[2].alike
    assert found[1].equal != found[3].equal
    assert found[5].equal == found[6].equal
    assert found[7].equal == found[3].equal and found[7].alike == found[3].alike
    rows = spark.createDataFrame([(found[3].equal, found[4].equal, found[3].alike, found[4].alike, found[1].equal, found[1].alike)], "ea array<bigint>, eb array<bigint>, aa array<bigint>, ab array<bigint>, ec array<bigint>, ac array<bigint>")
    added = combined(F.col("ea"), F.col("eb"), F.col("aa"), F.col("ab"))
    removed = combined(F.col("ec"), F.col("eb"), F.col("ac"), F.col("ab"), remove=True)
    r = rows.select(added[0].alias("e"), added[1].alias("a"), removed[0].alias("re"), removed[1].alias("ra")).first()
    assert (r.e, r.a) == (found[1].equal, found[1].alike)
    assert (r.re, r.ra) == (found[3].equal, found[3].alike)


def test_likeness(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    text = [rnd.choice(words) for _ in range(600)]
    other = [rnd.choice(words) for _ in range(600)]
    found = lanes(spark, [(1, " ".join(text)), (2, " ".join(text[:400] + other[:200])), (3, " ".join(other))])
    rows = spark.createDataFrame([(i, found[1].equal, found[i].equal, found[1].alike, found[i].alike) for i in (1, 2, 3)], "i int, ea array<bigint>, eb array<bigint>, aa array<bigint>, ab array<bigint>")
    near = {r.i: r.x for r in rows.select("i", likeness(F.col("ea"), F.col("eb"), F.col("aa"), F.col("ab")).alias("x")).collect()}
    assert near[1] == 1.0 and near[2] == pytest.approx(2 / 3, abs=0.25) and near[3] < 0.4


@pytest.mark.parametrize("rows", [[], [(1, "one")], [(5, None), (3, ""), (9, "abc def\nghi"), (7, "é" * 1000), (8, "abc def\nghi"), (None, "null id"), (3, "")]])
def test_query_against_python(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as bucket", "1 as place").write.parquet(f"{tmp_path}/documents.parquet")
    found = op2_fingerprint(spark, str(tmp_path)).collect()
    order = sorted(((float("-inf") if i is None else i, i, t or "") for i, t in rows), key=lambda x: (-x[0], x[2]))
    wanted, prints = [], {}
    for k, (_, i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][2]
        cut = len(t) // 3
        wanted.append((str(i), len(t), hashlib.sha256((t[: len(t) - cut] + following[:cut]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found) == sorted(wanted)
    for r in found:
        text = next(t or "" for i, t in rows if i == r.doc_id)
        assert prints.setdefault(r.fingerprint, text) == text
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_many_buckets(spark):
    """Neighbours meet whatever the bucket they fall in."""
    folder = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy(F.desc("doc_id")).collect()]
    found = {r.doc_id: r for r in op2_fingerprint(spark, folder).collect()}
    assert len(found) == len(texts)
    for k, (i, t) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        cut = len(t) // 3
        assert found[i].edited_sha256 == hashlib.sha256((t[: len(t) - cut] + following[:cut]).encode()).hexdigest()
    near = list(found.values())
    assert sum(r.near_edited for r in near) / len(near) > 0.5 > 0.2 > sum(r.near_next for r in near) / len(near)
