"""URL filtering by a temporal list join.

A list is a log of dated changes: from a day on, a pattern (a host, a domain with its subdomains, or a path below a host) is
blocked or allowed, or its entry is taken off. The changes become validity intervals. Each capture is looked up by all its
hosts, domains and path prefixes among the entries that were active on the day of its fetch; the longest pattern decides.

The as-of join is an equality join: intervals are cut at the borders of periods of ``PERIOD_DAYS`` days, and captures are
first reduced to the distinct pairs of pattern and day. A hot host then meets only a few intervals at a time, and counts
once a day, whatever the number of its captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockloom.llm.common import table

PERIOD_DAYS = 32


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and a final dot; empty if there is none."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*?)\.?(?::[0-9]*)?(?:[/?#]|$)", 1)


def path_of(url: Column) -> Column:
    """Path of a URL, from its first slash on, without query and fragment."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def patterns_of(url: Column) -> Column:
    """All (kind, pattern) under which a URL can be listed: its host, its domains, and its path up to each slash."""
    host, path = host_of(url), path_of(url)
    labels, steps = F.split(host, r"\."), F.split(path, "/")
    # every domain of two labels or more; a lone name is a host only
    domains = F.when(F.size(labels) >= 2, F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).otherwise(F.array().cast("array<string>"))
    prefixes = F.when(F.size(steps) >= 2, F.transform(F.sequence(F.lit(1), F.greatest(F.size(steps) - 1, F.lit(1))), lambda i: F.concat(host, F.array_join(F.slice(steps, 1, i), "/"), F.lit("/")))).otherwise(F.array().cast("array<string>"))
    found = F.concat(
        F.array(F.struct(F.lit("host").alias("kind"), host.alias("pattern"))),
        F.transform(domains, lambda d: F.struct(F.lit("domain").alias("kind"), d.alias("pattern"))),
        F.transform(prefixes, lambda p: F.struct(F.lit("path").alias("kind"), p.alias("pattern"))),
    )
    return F.when(host == "", F.slice(found, 1, 0)).otherwise(found)


def intervals(changes: DataFrame) -> DataFrame:
    """Validity intervals [``valid_from``, ``valid_to``) of the entries of ``changes`` (kind, pattern, day, verdict).

    ``verdict`` is "block", "allow" or "off". An entry holds until the pattern's next change; without one, ``valid_to`` is
    null. Of several changes on one day "block" counts, then "allow". Rows with a null pattern, kind, day or an unknown
    verdict are left out. A pattern has at most one change a day, so its window is bounded by the days of the log.
    """
    rank = F.when(F.col("verdict") == "block", 0).when(F.col("verdict") == "allow", 1).otherwise(2)
    known = changes.where(F.col("verdict").isin("block", "allow", "off")).select("kind", "pattern", "day", F.struct(rank.alias("rank"), F.col("verdict")).alias("v")).dropna(subset=["kind", "pattern", "day"])
    daily = known.groupBy("kind", "pattern", "day").agg(F.min("v").alias("v"))
    ahead = F.lead("day").over(Window.partitionBy("kind", "pattern").orderBy("day"))
    return daily.select("kind", "pattern", F.col("v.verdict").alias("verdict"), F.col("day").alias("valid_from"), ahead.alias("valid_to")).where("verdict <> 'off'")


def judged(captures: DataFrame, changes: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with ``verdict`` ("block", "allow", or "none") and ``matched`` (the deciding pattern, or null).

    The longest active pattern decides; of equally long ones "block", then the kinds in alphabetical order. A capture
    whose URL has no host, or with a null day, gets "none". All rows and other columns stay, repeated rows too.
    """
    period = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / PERIOD_DAYS)
    looked_up = captures.select(F.col(url).alias("_url"), F.col(fetched).cast("date").alias("_day")).dropna().distinct()
    wanted = looked_up.select("_url", "_day", F.inline(patterns_of(F.col("_url"))))
    days = wanted.select("kind", "pattern", "_day").distinct().withColumn("period", period(F.col("_day")))
    span = looked_up.agg(F.min("_day").alias("low"), F.max("_day").alias("high")).first()
    if span["low"] is None:
        return captures.withColumn("verdict", F.lit("none")).withColumn("matched", F.lit(None).cast("string"))
    low, high = F.lit(span["low"]), F.lit(span["high"])
    held = intervals(changes).where((F.col("valid_from") <= high) & (F.col("valid_to").isNull() | (F.col("valid_to") > low)))
    first, last = F.greatest("valid_from", low), F.least(F.coalesce(F.date_sub("valid_to", 1), high), high)
    cut = held.withColumn("period", F.explode(F.sequence(period(first), period(last))))
    active = (F.col("_day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to")))
    met = days.join(cut, ["kind", "pattern", "period"]).where(active).select("kind", "pattern", "_day", "verdict")
    order = F.struct((-F.length("pattern")).alias("size"), (F.col("verdict") != "block").alias("other"), F.col("kind"), F.col("pattern"), F.col("verdict"))
    chosen = wanted.join(met, ["kind", "pattern", "_day"]).groupBy("_url", "_day").agg(F.min(order).alias("_best"))
    same = (F.col(url) == F.col("_url")) & (F.col(fetched).cast("date") == F.col("_day"))
    out = captures.join(chosen, same, "left")
    return out.withColumn("verdict", F.coalesce("_best.verdict", F.lit("none"))).withColumn("matched", F.col("_best.pattern")).drop("_url", "_day", "_best")


def list_changes(pages: DataFrame) -> DataFrame:
    """A dated list drawn from the pages themselves, as the tables have none: hosts, domains and paths of the pages, their
    days and verdicts taken from digests of the patterns."""
    patterns = pages.select(F.inline(patterns_of(F.col("url")))).where("pattern <> ''").distinct()
    figure = F.conv(F.substring(F.md5(F.concat("kind", F.lit(" "), "pattern")), 1, 6), 16, 10).cast("int")
    drawn = patterns.withColumn("v", figure)
    start = F.to_date(F.lit("2024-01-01"))
    verdict = F.when(F.col("v") % 3 == 0, "allow").otherwise("block")
    listed = drawn.where("kind = 'host' AND v % 2 = 0 OR kind = 'domain' AND v % 3 = 0 OR kind = 'path' AND v % 5 = 0")
    begin = F.col("v") % 300

    def change(day: Column, what: Column) -> Column:
        return F.struct(F.date_add(start, day).alias("day"), what.alias("verdict"))

    rows = F.array(
        change(begin, verdict),
        change(begin + 60 + F.col("v") % 97, F.lit("off")),
        change(begin + 200 + F.col("v") % 83, F.when(F.col("v") % 7 < 4, verdict).otherwise("off")),
    )
    return listed.select("kind", "pattern", F.inline(rows))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page at its day of fetch (drawn from its number) under the list as it stood on that day."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.to_date(F.lit("2024-01-01")), F.pmod(F.col("page_id") * 37, F.lit(730)).cast("int"))
    found = judged(pages.withColumn("fetched", fetched), list_changes(pages))
    return found.select("page_id", "url", "fetched", "verdict", "matched")


SQL = r"""
WITH pages_at AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 730 AS INTEGER) AS fetched,
    regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*?)\.?(?::[0-9]*)?(?:[/?#]|$)', 1) AS host,
    regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
parts AS (SELECT page_id, url, fetched, host, string_split(host, '.') AS labels, string_split(path, '/') AS steps FROM pages_at WHERE host <> ''),
wanted AS (
  SELECT page_id, url, fetched, 'host' AS kind, host AS pattern FROM parts
  UNION ALL
  SELECT page_id, url, fetched, 'domain', array_to_string(labels[i:], '.') FROM (SELECT *, unnest(range(1, greatest(len(labels), 1))) AS i FROM parts WHERE len(labels) >= 2)
  UNION ALL
  SELECT page_id, url, fetched, 'path', host || array_to_string(steps[1:i], '/') || '/' FROM (SELECT *, unnest(range(1, greatest(len(steps), 1))) AS i FROM parts WHERE len(steps) >= 2)),
drawn AS (SELECT kind, pattern, CAST('0x' || substr(md5(kind || ' ' || pattern), 1, 6) AS INTEGER) AS v FROM (SELECT DISTINCT kind, pattern FROM wanted)),
listed AS (SELECT *, CASE WHEN v % 3 = 0 THEN 'allow' ELSE 'block' END AS own, DATE '2024-01-01' + CAST(v % 300 AS INTEGER) AS start_day FROM drawn
  WHERE kind = 'host' AND v % 2 = 0 OR kind = 'domain' AND v % 3 = 0 OR kind = 'path' AND v % 5 = 0),
changes AS (
  SELECT kind, pattern, start_day AS day, own AS verdict FROM listed
  UNION ALL SELECT kind, pattern, start_day + CAST(60 + v % 97 AS INTEGER), 'off' FROM listed
  UNION ALL SELECT kind, pattern, start_day + CAST(200 + v % 83 AS INTEGER), CASE WHEN v % 7 < 4 THEN own ELSE 'off' END FROM listed),
decided AS (
  SELECT w.page_id, w.fetched, w.kind, w.pattern, arg_max(c.verdict, c.day) AS verdict
  FROM wanted w JOIN changes c ON w.kind = c.kind AND w.pattern = c.pattern AND c.day <= w.fetched
  GROUP BY w.page_id, w.fetched, w.kind, w.pattern),
best AS (
  SELECT page_id, verdict, pattern, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, verdict <> 'block', kind) AS place
  FROM decided WHERE verdict <> 'off')
SELECT p.page_id, p.url, p.fetched, coalesce(b.verdict, 'none') AS verdict, b.pattern AS matched
FROM pages_at p LEFT JOIN best b ON p.page_id = b.page_id AND b.place = 1
"""
