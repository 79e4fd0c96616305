import numpy as np
import pytest

from stockloom.operators import boosting as b


def plain(x, y, loss, rounds, step, leaves, depth, l2, min_leaf):
    """The same model row by row: every leaf looked at for every split. Values are their own bins."""
    mean = y.mean()
    raw = np.full(len(y), mean if loss == "squared" else np.log(mean / (1 - mean)))
    for _ in range(rounds):
        p = raw if loss == "squared" else 1 / (1 + np.exp(-raw))
        g = np.rint((y - p) * 2**20) / 2**20
        h = np.ones(len(y)) if loss == "squared" else p * (1 - p)
        cells = [(np.arange(len(y)), 0)]

        def split(cell, level):
            best = (1e-12, None, None)
            if level >= depth:
                return best
            for f in range(x.shape[1]):
                for v in np.unique(x[cell, f])[:-1]:
                    a, c = cell[x[cell, f] <= v], cell[x[cell, f] > v]
                    if min(len(a), len(c)) < min_leaf:
                        continue
                    gain = g[a].sum() ** 2 / (len(a) + l2) + g[c].sum() ** 2 / (len(c) + l2) - g[cell].sum() ** 2 / (len(cell) + l2)
                    if gain > best[0] + 1e-9:
                        best = (gain, a, c)
            return best

        options = [split(*cells[0])]
        while len(cells) < leaves:
            k = max(range(len(cells)), key=lambda i: options[i][0])
            _, left, right = options[k]
            if left is None:
                break
            level = cells[k][1] + 1
            cells[k : k + 1] = [(left, level), (right, level)]
            options[k : k + 1] = [split(left, level), split(right, level)]
        new = raw.copy()
        for cell, _ in cells:
            new[cell] += step * g[cell].sum() / (h[cell].sum() + l2)
        raw = new
    return raw if loss == "squared" else 1 / (1 + np.exp(-raw))


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 12, 500), rng.integers(0, 5, 500), rng.integers(-3, 30, 500) / 4]).astype(float)
    y = np.rint(10 * np.sin(x[:, 0]) + 3 * x[:, 1] + x[:, 2] * (x[:, 1] > 2) + rng.normal(size=500))
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "i long, a double, b double, c double, y double").repartition(parts)


@pytest.mark.parametrize("loss, leaves, depth, l2, min_leaf", [("squared", 9, 99, 0.2, 15), ("squared", 40, 4, 0.0, 1), ("logistic", 8, 3, 0.0, 1)])
def test_equals_the_plain_version(spark, table, monkeypatch, loss, leaves, depth, l2, min_leaf):
    monkeypatch.setattr(b, "BLOCK_ROWS", 150)  # several blocks
    monkeypatch.setattr(b, "CHECKPOINT_EVERY", 2)
    x, y = table
    if loss == "logistic":
        y = (y > np.median(y)).astype(float)
    settings = dict(rounds=4, step=0.3, leaves=leaves, depth=depth, l2=l2, min_leaf=min_leaf)
    df = frame(spark, x, y)
    model = b.fit_boosted_trees(df, ["a", "b", "c"], "y", loss, **settings)
    found = np.array([r.p for r in model.score(df, "p").orderBy("i").collect()])
    assert np.allclose(found, plain(x, y, loss, **settings), atol=1e-4)
    assert sum(model.importance()) == pytest.approx(1)
    again = b.fit_boosted_trees(frame(spark, x, y, 7), ["a", "b", "c"], "y", loss, **settings)
    assert again.trees == model.trees
    monkeypatch.setattr(b, "BLOCK_ROWS", 10_000)
    assert b.fit_boosted_trees(df, ["a", "b", "c"], "y", loss, **settings).trees == model.trees  # one block


def test_bins_of_many_values(spark):
    df = spark.range(20_000).selectExpr("double(id % 7) as few", "pow(id, 2) as many", "if(id < 15000, 0D, double(id)) as heavy")
    few, many, heavy = b.bin_edges(df, ["few", "many", "heavy"])
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5]
    counts = np.bincount(np.searchsorted(many, np.arange(20_000.0) ** 2), minlength=255)
    assert len(many) == 254 and counts.min() >= 77 and counts.max() <= 80
    assert 0 < heavy[0] < 15_001 and len(heavy) < 255


def test_saved_model_scores_alike_and_is_checked(spark, table, tmp_path):
    x, y = table
    df = frame(spark, x, y)
    model = b.fit_boosted_trees(df, ["a", "b", "c"], "y", rounds=4)
    model.save(spark, str(tmp_path))
    session = spark.newSession()
    back = b.BoostedTrees.load(session, str(tmp_path), ["a", "b", "c"])
    assert [r.p for r in back.score(df, "p").orderBy("i").collect()] == [r.p for r in model.score(df, "p").orderBy("i").collect()]
    with pytest.raises(ValueError, match="fitted on"):
        b.BoostedTrees.load(spark, str(tmp_path), ["a", "c", "b"])
    spark.read.parquet(f"{tmp_path}/nodes").where("tree < 2").write.parquet(f"{tmp_path}/cut/nodes")
    spark.read.parquet(f"{tmp_path}/about").write.parquet(f"{tmp_path}/cut/about")
    with pytest.raises(ValueError, match="2 of 4 trees"):
        b.BoostedTrees.load(spark, f"{tmp_path}/cut")


def test_tables_without_anything_to_learn(spark):
    df = spark.createDataFrame([(0, None, 1.0, 1.0, 5.0), (1, 2.0, None, 1.0, None)], "i long, a double, b double, c double, y double")
    assert b.fit_boosted_trees(df.limit(0), ["a", "b", "c"], "y").trees == []
    assert [r.p for r in b.fit_boosted_trees(df, ["a", "b", "c"], "y", rounds=3).score(df, "p").collect()] == [5.0, 5.0]
    sure = b.fit_boosted_trees(df.selectExpr("*", "1 as late"), ["a", "b", "c"], "late", "logistic")
    assert sure.trees == [] and sure.score(df, "p").first().p > 0.99
