import pytest

from stockloom.llm.op5_quality import Logistic, classified, fitted, op5_quality, posteriors, properties, byte_kinds


def test_properties():
    kinds = byte_kinds()
    assert properties("", kinds) is None and properties(" \n ", kinds) is None
    calm = properties("this is a calm sentence, with words.", kinds)
    loud = properties("THIS!! IS!! LOUD!! LOUD!! LOUD!!", kinds)
    assert loud[0] > calm[0] and loud[6] > 0


def test_sparse_sites_shrink_toward_their_host(spark):
    rows = [("h1", "a", 4.0)] * 200 + [("h2", "a", -4.0)] * 200 + [("h2", "new", 4.0)] + [("h3", "a", 4.0)] + [(None, None, 0.0)] * 3
    found = {(r.host, r.path): r for r in posteriors(spark.createDataFrame(rows, "source string, lang string, log_odds double"), "source", "lang").collect()}
    assert len(found) == 5 and found[None, None].n == 3
    assert found["h1", "a"].host_posterior > 0.9 > 0.1 > found["h2", "a"].host_posterior
    overall = sum(r.good for r in found.values()) / sum(r.n for r in found.values())
    assert overall < found["h3", "a"].host_posterior < 0.98
    assert found["h2", "new"].host_posterior == found["h2", "a"].host_posterior


def test_a_bad_site_weighs_on_a_doubtful_text(spark):
    model = Logistic.__new__(Logistic)
    import numpy as np

    from stockloom.llm.op5_quality import PROPERTIES

    model.share, model.center, model.spread = 0.5, np.zeros(len(PROPERTIES)), np.ones(len(PROPERTIES))
    model.weights = np.zeros(len(PROPERTIES) + 1)
    model.weights[1] = -8.0  # capitals
    rows = [(i, "good", "x", "all calm words here") for i in range(50)] + [(100 + i, "bad", "x", "ALL LOUD WORDS") for i in range(50)]
    rows += [(200, "good", "x", "Half Calm wordS"), (201, "bad", "x", "Half Calm wordS"), (202, "bad", "x", None), (203, None, None, "calm")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").selectExpr("*", "1 as n", "0.0 as log_odds", "'z' as host")
    found = {r.doc_id: r for r in classified(docs, model).collect()}
    assert len(found) == len(rows) and found[200].host == "z"
    assert found[200].quality_score > found[201].quality_score
    assert found[202].quality_score < 0.01
    assert classified(docs.limit(0), model).count() == 0


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    model = fitted(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert model.share == 0.5
    model = fitted(docs, spark.createDataFrame([(1, 1), (None, 0), (2, 0), (1, None), (1, 1)], "doc_id long, quality int"))
    assert model.share > 0.9


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = fitted(docs, labels.where("doc_id % 3 <> 0"))
    scored = classified(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    assert len(scored) > 100
    assert sum((r.quality_score >= 0.5) == (r.quality == 1) for r in scored) / len(scored) > 0.97
    assert all(r.quality_score >= 0.5 for r in scored if r.quality == 1)


@pytest.mark.parametrize("sf", ["0.001"])
def test_query(spark, sf):
    found = op5_quality(spark, f"/root/testdata/sf{sf}").collect()
    assert len(found) == 200 and len({r.doc_id for r in found}) == 200
    assert all(0 <= r.quality_score <= 1 and r.kept == (r.quality_score >= 0.5) for r in found)
