import re
from collections import defaultdict

import corpus_pipeline


def shingles(text, k):
    words = re.findall("[^\x20\x09-\x0d]+", text.lower())
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()



def test_stages_and_run(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "line_dedup", "near_duplicates", "packing"]
    kept = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder).cache()
        assert now.dtypes == docs.dtypes
        kept[name] = {r.doc_id: r.text for r in now.collect()}
    bad = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()} - kept["quality"].keys()
    assert not bad & {r.doc_id for r in docs.collect()}
    rejected = [t for i, t in kept["quality"].items() if i not in kept["language"]]
    assert len(rejected) < 4 and all(len(t.split()) < 5 for t in rejected)
    assert kept["line_dedup"].keys() == kept["language"].keys()
    left = kept["near_duplicates"]
    sets = {i: shingles(t, 5) for i, t in left.items()}
    assert not any(a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a in sets for b in sets)
    pieces = defaultdict(int)
    for p in corpus_pipeline.run(spark, folder).collect():
        pieces[p.doc_id] += p.length
        assert len(p.ids) == p.length
    assert pieces.keys() == left.keys()


def test_clashing_columns(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60).selectExpr("*", "1 as log_odds", "2 as score", "'x' as h", "3 as n", "'y' as lang_pred")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert all((r.log_odds, r.score, r.h, r.n, r.lang_pred) == (1, 2, "x", 3, "y") for r in out.collect())


def test_copies_are_told_apart_by_row(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(1, a), (1, a), (2, a), (2, b), (None, c), (None, c), (None, d), (7, d), (5, d), (5, d + " more"), (8, None), (8, None), (None, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string").repartition(3)
    found = corpus_pipeline.near_duplicates(spark, docs, "")
    assert found.columns == docs.columns
    left = sorted(((r.doc_id, (r.text or "-")[0]) for r in found.collect()), key=str)
    assert left == sorted([(1, "a"), (2, "b"), (None, "c"), (5, "d"), (8, "-"), (8, "-"), (None, "-")], key=str)


def test_foreign_and_noise_are_rejected(spark):
    import random

    rnd = random.Random(1)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    noise = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(1, 9))) for _ in range(200))
    foreign = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä."
    planted = spark.createDataFrame([(-1, noise, None), (-2, foreign, None)], docs.schema)
    for learned in (["en"], ["en", "de"], ["en", "de", "es", "fr"]):
        some = docs.where(docs.lang.isin(learned))
        left = {r.doc_id for r in corpus_pipeline.language(spark, some.union(planted), "").collect()}
        assert not left & {-1, -2}
        assert some.where(~some.doc_id.isin(*left)).where("size(split(text, ' ')) > 4").count() == 0
