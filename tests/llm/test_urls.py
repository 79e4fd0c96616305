import datetime as dt

import duckdb
import pytest

from stockloom.llm.op3_urls import SQL, intervals, judged, op3_url_filter

DAY = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(n)


def changes(spark, rows):
    return spark.createDataFrame([(k, p, day(d), v) for k, p, d, v in rows], "kind string, pattern string, day date, verdict string")


def test_intervals(spark):
    rows = [("host", "a.b", 5, "block"), ("host", "a.b", 9, "off"), ("host", "a.b", 9, "allow"), ("host", "a.b", 9, "allow"), ("host", "a.b", 12, "off"), ("host", "a.b", 20, "block"), (None, "x", 1, "block"), ("host", None, 1, "block"), ("host", "x", None, "block"), ("host", "x", 1, "other"), ("host", "y", 3, None)]
    found = sorted((r.verdict, r.valid_from, r.valid_to) for r in intervals(changes(spark, rows)).collect() if r.valid_to)
    assert found == [("allow", day(9), day(12)), ("block", day(5), day(9))]
    assert [(r.pattern, r.valid_from) for r in intervals(changes(spark, rows)).where("valid_to is null").collect()] == [("a.b", day(20))]


def test_entries_active_at_fetch_time(spark):
    log = [("domain", "bad.org", 10, "block"), ("host", "good.bad.org", 12, "allow"), ("path", "good.bad.org/x/", 14, "block"), ("domain", "bad.org", 200, "off"), ("host", "old.org", -900, "block")]
    captures = [(1, "http://www.bad.org/a", 9), (2, "http://www.bad.org/a", 10), (3, "HTTPS://user@Good.BAD.org.:8080/x/y?z#q", 13), (4, "https://good.bad.org/x/y", 14), (5, "https://good.bad.org/xy", 14), (6, "http://bad.org", 199), (7, "http://bad.org", 200), (8, "http://notbad.org/", 20), (9, None, 20), (10, "no url", 20), (11, "http://bad.org", None), (12, "http://old.org", 700), (12, "http://old.org", 700), (13, "http:///x", 5), (14, "", 5), (15, "http://localhost/x", 5)]
    frame = spark.createDataFrame([(i, u, day(d)) for i, u, d in captures], "page_id long, url string, fetched date").selectExpr("*", "'k' as kind", "1 as period", "'p' as pattern")
    found = {r.page_id: (r.verdict, r.matched) for r in judged(frame, changes(spark, log)).collect()}
    block = ("block", "bad.org")
    none = ("none", None)
    assert found == {1: none, 2: block, 3: ("allow", "good.bad.org"), 4: ("block", "good.bad.org/x/"), 5: ("allow", "good.bad.org"), 6: block, 7: none, 8: none, 9: none, 10: none, 11: none, 12: ("block", "old.org"), 13: none, 14: none, 15: none}
    assert judged(frame, changes(spark, log)).count() == len(captures)
    assert {r.verdict for r in judged(frame, changes(spark, [])).collect()} == {"none"}
    assert judged(frame.limit(0), changes(spark, log)).count() == 0


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_against_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{folder}/pages.parquet'")
    wanted = con.sql(SQL).fetchall()
    found = [tuple(r) for r in op3_url_filter(spark, folder).collect()]
    assert sorted(map(str, found)) == sorted(map(str, wanted))
