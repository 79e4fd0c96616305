import numpy as np
import pytest

from stockloom.llm.links import components
from stockloom.llm.op7_embeddings import near_duplicates, op7_embedding_join


def brute_force(rows, threshold=0.95):
    ok = [i for i, (k, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i, (k, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((k, len(links[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return sorted(out, key=str)


def check(spark, rows, kind="double", **settings):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "'x' as id", "1 as copies")
    found = [(r.vec_id, r.n_links, r.component_id) for r in near_duplicates(frame, **settings).collect()]
    assert sorted(found, key=str) == brute_force(rows)


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 12))
    rows = [(int(i), (centres[rng.integers(20)] + rng.normal(size=12) * rng.choice([0.05, 0.25, 1.0])).tolist()) for i in rng.permutation(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    check(spark, rows, tile=[4096, 100, 25][seed])


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1e200, 1e199]), (10, [1e-200, 0.0]), (11, [1.0, 0.0, 0.0]), (12, [1.0, 0.0, 0.1]), (None, [1.0, 0.0]), (13, [-1.0, 0.0])]
    check(spark, rows)
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0
    check(spark, [(2, [1.0, 0.01]), (2, [0.0, 1.0]), (1, [1.0, 0.0]), (3, [0.01, 1.0])])
    check(spark, [(None, [1.0, 0.0]), (None, [1.0, 0.01]), (None, [0.0, 1.0]), (4, [0.01, 1.0]), (None, None)])
    found = near_duplicates(spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert all(r.kept and r.n_links == 0 and r.component_id == r.vec_id for r in found)


def test_dense_groups_and_lengths(spark):
    """A group in which all link, beside others of two lengths, over tiles that hold both lengths."""
    rng = np.random.default_rng(3)
    rows = [(i, (np.eye(20)[0] + rng.normal(size=20) * 0.01).tolist()) for i in range(150)]
    rows += [(200 + i, rng.normal(size=20 if i % 3 else 3).tolist()) for i in range(300)]
    check(spark, rows)
    check(spark, rows, "float", tile=60)


def test_few_pairs_are_compared():
    from stockloom.llm import op7_embeddings

    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(2000, 64))
    work = op7_embeddings.Join(vectors, op7_embeddings.principal(op7_embeddings.unit(vectors[:500])), np.ones(2000, np.int64), 0.95)
    work.join(range(2000), range(2000))
    assert work.compared < 0.01 * 2000 * 1999 / 2 and not work.links.any()


def test_given_embeddings(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = op7_embedding_join(spark, folder).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in found], key=str) == brute_force(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


@pytest.mark.parametrize("axes", [True, False])
def test_tiles_stay_small(spark, monkeypatch, axes):
    """Beside one longer vector, and where all vectors have one place."""
    from stockloom.llm import op7_embeddings

    rng = np.random.default_rng(8)
    rows = [(i, [0.0] * 4 + rng.normal(size=4).tolist()) for i in range(120)] + [(1000, [1.0] * 9)]
    if not axes:
        monkeypatch.setattr(op7_embeddings, "SAMPLE_VALUES", 0)  # the first components, which are zero
    seen = []
    pairs = op7_embeddings.tile_pairs
    monkeypatch.setattr(op7_embeddings, "tile_pairs", lambda tiles, *rest: seen.append(tiles) or pairs(tiles, *rest))
    check(spark, rows, tile=40)
    assert max(r["count"] for r in seen[0].groupBy("tile").count().collect()) <= 80


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, size=(200, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
