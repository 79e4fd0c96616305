"""Document fingerprints by a homomorphic multiset hash of paragraphs.

Each paragraph (line) of a text is hashed to a wide vector, and the fingerprint is the sum of the vectors modulo powers of
two: it doesn't depend on the order of paragraphs, and a paragraph is inserted or deleted by adding or subtracting its
vector. A vector has two parts. ``EQUAL`` lanes modulo 2^62 are hashed from the whole paragraph; equal multisets have equal
lanes, others differ but for a chance of about 2^-200. ``ALIKE`` lanes modulo 2^16 hold, for every word of the paragraph
with the two that follow it, +1 or -1 in one hashed lane; the difference of two sums then estimates in how many of these
word groups two texts differ, from the fingerprints alone.

Texts move once, to buckets of neighbouring ids. All later grouping and windows keep that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockloom.llm.common import shuffle_parts, table, text_of

EQUAL, ALIKE = 4, 64
EQUAL_MASK, ALIKE_MODULUS = (1 << 62) - 1, 1 << 16
BUCKETS_A_PARTITION = 4


def equal_lanes(text: Column) -> list[Column]:
    """Sums over the paragraphs of ``text``, modulo 2^62."""
    mask = F.lit(EQUAL_MASK)

    def lane(j: int) -> Column:
        return F.aggregate(F.split(text, "\n"), F.lit(0).cast("bigint"), lambda total, p: (total + F.xxhash64(F.lit(j), p).bitwiseAND(mask)).bitwiseAND(mask))

    return [lane(j) for j in range(EQUAL)]


def word_groups(words: Column) -> Column:
    """Hash of every word of a paragraph with the two words after it, as far as there are any. ``words`` must be a column:
    an expression would be evaluated anew for each word."""
    return F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def alike_lanes(groups: DataFrame, keys: list[str], largest: list[str]) -> DataFrame:
    """Sums of the lanes over the hashes ``g`` of word groups, and the largest of some columns, for each value of ``keys``.

    A hash adds +1 or -1 to one lane, so it is summed lane by lane first; only these sums are turned into columns.
    """
    g = F.col("g")
    single = groups.select(*keys, *largest, g.bitwiseAND(F.lit(ALIKE - 1)).alias("lane"), F.when(g < 0, -1).when(g >= 0, 1).otherwise(0).alias("sign"))
    lanes = single.groupBy(*keys, "lane").agg(*[F.max(c).alias(c) for c in largest], F.sum("sign").alias("sum"))
    return lanes.groupBy(*keys).agg(*[F.max(c).alias(c) for c in largest], *[F.sum(F.when(F.col("lane") == j, F.col("sum")).otherwise(0)).alias(f"a{j}") for j in range(ALIKE)])


def as_text(equal: Column, alike: Column) -> Column:
    """Fingerprint in hexadecimal: equality lanes of 16 digits, likeness lanes of 4."""
    return F.lower(F.concat(F.concat_ws("", F.transform(equal, lambda x: F.lpad(F.hex(x), 16, "0"))), F.concat_ws("", F.transform(alike, lambda x: F.lpad(F.hex(F.pmod(x, F.lit(ALIKE_MODULUS))), 4, "0")))))


def signed(alike: Column) -> Column:
    """Lanes as the residues nearest to zero."""
    half = ALIKE_MODULUS // 2
    return F.transform(alike, lambda x: F.pmod(x + half, F.lit(ALIKE_MODULUS)) - half)


def combined(equal_a: Column, equal_b: Column, alike_a: Column, alike_b: Column, remove: bool = False) -> tuple[Column, Column]:
    """Lanes after inserting (or deleting) paragraphs whose own lanes are given second."""
    step = -1 if remove else 1
    equal = F.zip_with(equal_a, equal_b, lambda a, b: (a + (F.lit(EQUAL_MASK) - b + 1 if remove else b)).bitwiseAND(F.lit(EQUAL_MASK)))
    return equal, F.zip_with(alike_a, alike_b, lambda a, b: F.pmod(a + step * b, F.lit(ALIKE_MODULUS)))


def likeness(equal_a: Column, equal_b: Column, alike_a: Column, alike_b: Column) -> Column:
    """1 for equal fingerprints; otherwise the estimated share of common word groups, 0 to 1."""
    zero = F.lit(0).cast("bigint")
    a, b = signed(alike_a), signed(alike_b)
    both = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), zero, lambda t, x: t + x)
    own = F.aggregate(F.zip_with(a, b, lambda x, y: x * x + y * y), zero, lambda t, x: t + x)
    share = F.coalesce(F.try_divide(2.0 * both, own.cast("double")), F.lit(0.0))
    return F.when(equal_a == equal_b, 1.0).otherwise(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row for each distinct value of ``keys``: ``equal`` and ``alike`` lanes of all its texts' paragraphs together.

    Null text counts as empty: one empty paragraph. Null keys group like values. An empty table gives no row. A key's
    paragraphs are summed in every task before they move, so a hot key moves one row for each task.
    """
    paragraphs = texts.select(*keys, F.explode(F.split(text_of(text), "\n")).alias("_p"))
    mask = F.lit(EQUAL_MASK)
    halves = 1 << 31
    equal = []
    for j in range(EQUAL):
        h = F.xxhash64(F.lit(j), F.col("_p")).bitwiseAND(mask)
        high, low = F.sum(F.shiftright(h, 31)), F.sum(h.bitwiseAND(F.lit(halves - 1)))
        equal.append(((F.pmod(high, F.lit(halves)) * F.lit(halves) + low).bitwiseAND(mask)).alias(f"e{j}"))
    whole = paragraphs.groupBy(*keys).agg(*equal)
    words = paragraphs.select(*keys, F.split("_p", " ").alias("_w"))
    groups = alike_lanes(words.select(*keys, F.explode(word_groups(F.col("_w"))).alias("g")), keys, [])
    names = [F.col(f"a{j}") for j in range(ALIKE)]
    condition = None
    for k in keys:
        same = F.col(f"w.{k}").eqNullSafe(F.col(f"g.{k}"))
        condition = same if condition is None else condition & same
    joined = whole.alias("w").join(groups.alias("g"), condition)
    return joined.select(*[F.col(f"w.{k}") for k in keys], F.array(*[F.col(f"e{j}") for j in range(EQUAL)]).alias("equal"), F.transform(F.array(*names), lambda x: F.pmod(x, F.lit(ALIKE_MODULUS))).alias("alike"))


def by_next_id(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (bucket, place, extra, doc_id, text, next_text): each document with the next one in descending order of ids.

    Buckets are ranges of ids between quantiles, a few for each shuffle partition. The first document of a bucket is also
    sent, marked ``extra``, to the bucket that it follows on, so every pair meets. Rows with the same id follow in the
    order of their texts; a null id comes after all others; null text is empty.
    """
    spark = docs.sparkSession
    n = BUCKETS_A_PARTITION * shuffle_parts(spark)
    rows = docs.select(F.coalesce(F.col(doc_id), F.lit(-(1 << 63))).alias("id"), F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    shares = [i / n for i in range(1, n)]
    bounds = sorted(set(rows.agg(F.percentile_approx("id", shares, 10_000).alias("b")).first()["b"] or []))
    width = max(1, int(len(bounds) ** 0.5))
    every = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    coarse = F.array(*[F.lit(b).cast("bigint") for b in bounds[width - 1 :: width]]) if bounds else F.array().cast("array<bigint>")
    run = F.size(F.filter(coarse, lambda b: b < F.col("id")))
    rows = rows.withColumn("run", run)
    inner = F.slice(every, F.col("run") * width + 1, width)
    rows = rows.withColumn("bucket", (F.col("run") * width + F.size(F.filter(inner, lambda b: b < F.col("id")))).cast("int")).drop("run")
    firsts = {r["bucket"]: r["first"] for r in rows.groupBy("bucket").agg(F.max("id").alias("first")).collect()}  # one row a bucket
    there = sorted(firsts)
    after = dict(zip(there, [*there[1:], *there[:1]], strict=True))
    size = max(there, default=0) + 1
    first = F.array(*[F.lit(firsts.get(b)).cast("bigint") for b in range(size)])
    goes_to = F.array(*[F.lit(after.get(b)).cast("int") for b in range(size)])
    own = F.struct(F.col("bucket"), F.lit(False).alias("extra"))
    extra = F.struct(F.get(goes_to, F.col("bucket")).alias("bucket"), F.lit(True).alias("extra"))
    places = F.when(F.get(first, F.col("bucket")) == F.col("id"), F.array(own, extra)).otherwise(F.array(own))
    rows = rows.select("id", "doc_id", "text", F.inline(places))
    order = Window.partitionBy("bucket").orderBy("extra", F.desc("id"), "text")
    return rows.select("bucket", F.row_number().over(order).alias("place"), "extra", "doc_id", "text", F.lead("text").over(order).alias("next_text"))


def edited(text: Column, next_text: Column) -> Column:
    """``text`` whose last third is replaced by the first code points of ``next_text``."""
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(F.coalesce(next_text, F.lit("")), F.lit(1), cut))


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how much they are alike."""
    rows = by_next_id(table(spark, sf_dir, "documents")).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    digest = F.sha2("edited", 256)
    rows = rows.select(
        "bucket",
        "place",
        "extra",
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        # the digest as whole numbers: the aggregate below then keeps to fixed-width values
        *[F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("bigint").alias(f"s{i}") for i in range(5)],
        F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")))),
    )
    keys = ["bucket", "place", "kind", "extra", "doc_id", "n_chars"]
    sums = [f"s{i}" for i in range(5)] + [f"e{j}" for j in range(EQUAL)]
    rows = rows.select(*keys, *sums[:5], "t", *[c.alias(f"e{j}") for j, c in enumerate(equal_lanes(F.col("t")))])
    paragraphs = rows.select(*keys, *sums, F.explode(F.split("t", "\n")).alias("p"))
    words = paragraphs.select(*keys, *sums, F.split("p", " ").alias("w"))
    groups = words.select(*keys, *sums, F.explode(word_groups(F.col("w"))).alias("g"))
    prints = alike_lanes(groups, keys, sums)
    prints = prints.select(
        *keys,
        F.lower(F.concat(*[F.lpad(F.hex(f"s{i}"), 15 if i < 4 else 4, "0") for i in range(5)])).alias("edited_sha256"),
        F.array(*[F.col(f"e{j}") for j in range(EQUAL)]).alias("equal"),
        F.array(*[F.col(f"a{j}") for j in range(ALIKE)]).alias("alike"),
    )
    order = Window.partitionBy("bucket").orderBy("place", "kind")
    for name, step in (("edited", 1), ("next", 2)):
        for part in ("equal", "alike"):
            prints = prints.withColumn(f"{name}_{part}", F.lead(part, step).over(order))
    prints = prints.where((F.col("kind") == 0) & ~F.col("extra"))
    return prints.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("equal"), F.col("alike")).alias("fingerprint"),
        as_text(F.col("edited_equal"), F.col("edited_alike")).alias("edited_fingerprint"),
        likeness(F.col("equal"), F.col("edited_equal"), F.col("alike"), F.col("edited_alike")).alias("near_edited"),
        likeness(F.col("equal"), F.col("next_equal"), F.col("alike"), F.col("next_alike")).alias("near_next"),
    )
