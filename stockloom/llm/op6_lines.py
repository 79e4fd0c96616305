"""Line deduplication by a suffix array over line numbers, built by distributed prefix doubling.

The lines of all documents are one long sequence. Lines that occur more than once are numbered in a fixed order; from the
numbers of all runs of 2^k lines, the numbers of runs of 2^(k+1) lines come by sorting the pairs of neighbours. These are the
ranks of suffixes by their first 2^k lines, and runs that occur once drop out at each step. The interval of suffixes that
have a longest common prefix of at least ``MIN_WORDS`` words is named by two overlapping runs of 2^k lines. The first suffix
of an interval stays, the prefix of every other one is deleted. As every maximal repeated run is the union of such prefixes
and, seen from its end, of such suffixes, all of it goes in the later copies.

DataFrame operations only. A line or a run that is very frequent is counted before anything moves, and found again by
joins, which Spark splits where they are skewed; windows see one document at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockloom.llm.common import shuffle_parts, stored, table, text_of

MIN_WORDS = 50
DOC = ["doc_id", "h"]


def numbered(distinct: DataFrame, order: list[str], name: str) -> DataFrame:
    """``distinct`` with dense numbers in the order of its columns: sorted by ranges, numbered within each, and moved up by
    the sizes of the ranges before (one figure for each)."""
    parts = shuffle_parts(distinct.sparkSession)
    ranged = distinct.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    sizes = {r["part"]: r["n"] for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in range(max(sizes, default=0) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranged.withColumn(name, (place + F.get(F.array(*[F.lit(b).cast("bigint") for b in before]), F.col("part"))).cast("bigint")).drop("part")


def lines_of(text: Column) -> Column:
    """Lines that aren't blank, with their places among all lines."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line_no"), x.alias("line"))), lambda s: F.trim(s["line"]) != "")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Every line that occurs more than once: document, place j among its lines, words, number of the line."""
    rows = docs.select(*DOC, F.posexplode(lines_of(F.col("text"))).alias("j", "s"))
    line = F.col("s.line")
    words = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    rows = rows.select(*DOC, "j", words.cast("bigint").alias("w"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))
    distinct = rows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")
    found = rows.join(numbered(distinct, ["a", "b"], "r"), ["a", "b"]).select(*DOC, "j", "w", "r")
    return stored(found.distinct(), "lines")  # rows that repeat id and text are one document


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Runs of repeated lines (document, first line ``a``, ``d`` lines) with at least ``min_words`` words that would have
    fewer without their last line, or without their first."""
    by_place = Window.partitionBy(*DOC).orderBy("j")
    rows = lines.withColumn("c", F.sum("w").over(by_place)).withColumn("seg", F.col("j") - F.row_number().over(by_place))
    seg = Window.partitionBy(*DOC, "seg")
    # from its first line: the nearest line at whose end enough words have been seen
    ends = F.struct(F.col("c").alias("key"), F.lit(0).alias("kind"), F.col("j").alias("found"), F.lit(None).cast("int").alias("own"))
    starts = F.struct((F.col("c") - F.col("w") + min_words).alias("key"), F.lit(1).alias("kind"), F.lit(None).cast("int").alias("found"), F.col("j").alias("own"))
    forward = rows.select(*DOC, "seg", F.inline(F.array(ends, starts)))
    forward = forward.withColumn("found", F.last("found", ignorenulls=True).over(seg.orderBy(F.desc("key"), "kind"))).where("kind = 1 and found is not null")
    forward = forward.select(*DOC, F.col("own").alias("a"), (F.col("found") - F.col("own") + 1).alias("d"))
    # from its last line: the nearest line from whose start on there are enough
    starts = F.struct((F.col("c") - F.col("w")).alias("key"), F.lit(0).alias("kind"), F.col("j").alias("found"), F.lit(None).cast("int").alias("own"))
    ends = F.struct((F.col("c") - min_words).alias("key"), F.lit(1).alias("kind"), F.lit(None).cast("int").alias("found"), F.col("j").alias("own"))
    backward = rows.select(*DOC, "seg", F.inline(F.array(starts, ends)))
    backward = backward.withColumn("found", F.last("found", ignorenulls=True).over(seg.orderBy("key", "kind"))).where("kind = 1 and found is not null")
    backward = backward.select(*DOC, F.col("found").alias("a"), (F.col("own") - F.col("found") + 1).alias("d"))
    return forward.union(backward).distinct()


def doubled(ranks: DataFrame, k: int) -> DataFrame:
    """Ranks by the first 2^(k+1) lines, from ranks by the first 2^k; runs that occur once are left out."""
    step = 1 << k
    ahead = Window.partitionBy(*DOC).orderBy("j").rangeBetween(step, step)
    pairs = ranks.select(*DOC, "j", "r", F.max("r").over(ahead).alias("s")).where("s is not null")
    distinct = pairs.groupBy("r", "s").agg(F.count("*").alias("n")).where("n > 1").select("r", "s")
    names = numbered(distinct, ["r", "s"], "next")
    return stored(pairs.join(names, ["r", "s"]).select(*DOC, "j", F.col("next").alias("r")), "ranks")


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document (id and hash of its text) the places of the lines that are later copies."""
    lines = repeated_lines(docs)
    found = stored(windows(lines, min_words), "windows")
    longest = found.agg(F.max("d").alias("d")).first()["d"] or 0
    ranks = lines.select(*DOC, "j", "r")
    levels = ranks.withColumn("k", F.lit(0))
    k = 0
    while 2 << k <= longest:
        ranks = doubled(ranks, k)
        k += 1
        levels = levels.union(ranks.withColumn("k", F.lit(k)))
    k = F.floor(F.log2(F.col("d") + 0.25)).cast("int")
    found = found.withColumn("k", k).withColumn("z", F.expr("a + d - shiftleft(1, k)"))
    head = levels.select(*[F.col(c).alias(f"_{c}") for c in DOC], F.col("k").alias("_k"), F.col("j").alias("_j"), "r")

    def at(frame: DataFrame, place: str, name: str) -> DataFrame:
        same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("h") == F.col("_h")) & (F.col("k") == F.col("_k")) & (F.col(place) == F.col("_j"))
        return frame.join(head.withColumnRenamed("r", name), same).select(*frame.columns, name)

    named = stored(at(at(found, "a", "x"), "z", "y"), "intervals")
    first = named.groupBy("d", "x", "y").agg(F.min(F.struct("doc_id", "h", "a")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = stored(first, "first-copies")  # read again, so that a skewed join can be split
    later = named.join(first, ["d", "x", "y"]).where(F.struct("doc_id", "h", "a") != F.col("first"))
    return later.select(*DOC, F.explode(F.sequence(F.col("a"), F.col("a") + F.col("d") - 1)).alias("j")).groupBy(*DOC).agg(F.collect_set("j").alias("gone"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without later copies of repeated runs of lines; ``lines_deleted`` tells how many lines went.

    A run counts if it has ``min_words`` words or more (pieces between spaces), in one line or several. "Later" is by id,
    then by place in the text; a null id comes first. Blank lines neither count nor part a run, and stay. A null text
    stays null, a text all of whose lines are copies becomes empty. Rows with the same id and the same text are one
    document and keep alike. All rows and other columns stay.
    """
    rows = docs.withColumn("_h", F.xxhash64(text_of(text)))
    gone = deleted_lines(rows.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col("_h").alias("h"), text_of(text).alias("text")), min_words)
    gone = gone.select(F.col("doc_id").alias("_d"), F.col("h").alias("_g"), F.col("gone").alias("_gone"))
    joined = rows.join(gone, F.col(doc_id).cast("bigint").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")), "left")
    changed = F.col("_gone").isNotNull()
    # columns of their own: inside a lambda an expression would be evaluated anew for each line
    joined = joined.withColumn("_parts", F.when(changed, F.split(F.col(text), "\n"))).withColumn("_own", F.when(changed, F.transform(lines_of(F.col(text)), lambda s: s["line_no"])))
    left = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.transform("_gone", lambda j: F.get("_own", j)))
    shorter = F.array_join(F.transform(left, lambda i: F.get("_parts", i)), "\n")
    out = joined.withColumn(text, F.when(changed, shorter).otherwise(F.col(text))).withColumn("lines_deleted", F.coalesce(F.size("_gone"), F.lit(0)))
    return out.drop("_h", "_d", "_g", "_gone", "_parts", "_own")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later copies of repeated runs of lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = deduplicated(docs)
    return out.select("doc_id", "text", F.char_length("text").cast("bigint").alias("n_chars"), F.col("lines_deleted").cast("bigint").alias("lines_deleted"))
