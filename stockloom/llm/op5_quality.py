"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic model on a few properties of a text gives each document a chance of being good. Grouped sums over all documents
turn these chances into posteriors of hosts and of paths below them: the host's mean is shrunk toward the global mean, the
path's toward its host's, each with the prior strength that the spread of the groups asks for. A document's score joins
its own evidence with what the other documents of its path say.

The logistic model is fitted on a bounded sample of the labelled rows (``max_labels``). Sums and posteriors cover all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import stored, table, text_of
from stockloom.shipping import hand_back_memory, share, ship_with_tasks

MAX_LABELS = 20_000
BROADCAST_ROWS = 200_000  # of posteriors; more are joined by a shuffle
WITHOUT_WORDS = -12.0  # log odds of a text that has no words
PROPERTIES = ["upper", "digit", "symbol", "space", "other", "point", "repeated_next", "distinct", "word_length", "log_words", "repeated_lines", "line_words", "lone_symbols"]


def byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.int64)  # 0: lower-case letters and whatever is not ASCII
    for b in range(128):
        c = chr(b)
        kinds[b] = 1 if c.isupper() else 2 if c.isdigit() else 4 if c.isspace() else 5 if not c.isprintable() else 6 if c in ".,;:?'\"-()" else 0 if c.isalpha() else 3
    return kinds


def properties(text: str, kinds: np.ndarray) -> list[float] | None:
    """Figures in the order of ``PROPERTIES``; none for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return None
    raw = np.frombuffer(text.encode(), np.uint8)
    share = np.bincount(kinds[raw], minlength=7) / len(raw)
    lines = text.split("\n")
    return [
        *(share[1:].tolist()),
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        sum(map(len, words)) / n,
        math.log1p(n),
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        sum(text.count(f" {s} ") for s in "|*#-") / n,
    ]


class Logistic:
    """Standardised properties, weights and the share of good rows it was fitted on."""

    def __init__(self, rows: np.ndarray, good: np.ndarray, ridge: float = 1.0) -> None:
        self.share = float(np.clip(good.mean(), 1e-3, 1 - 1e-3)) if len(good) else 0.5
        self.center = rows.mean(axis=0) if len(rows) else np.zeros(len(PROPERTIES))
        self.spread = np.maximum(rows.std(axis=0), 1e-6) if len(rows) else np.ones(len(PROPERTIES))
        self.weights = np.zeros(len(PROPERTIES) + 1)
        self.weights[0] = math.log(self.share / (1 - self.share))
        if 0 < good.sum() < len(good):
            x = self._scaled(rows)
            for _ in range(25):
                p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
                w = np.maximum(p * (1 - p), 1e-6)
                penalty = ridge * np.r_[0.0, np.ones(len(PROPERTIES))]
                self.weights += np.linalg.solve((x * w[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (good - p) - penalty * self.weights)

    def _scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(rows), 1)), np.clip((rows - self.center) / self.spread, -6, 6)])

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self._scaled(rows) @ self.weights, -20, 20)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _properties(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kinds = byte_kinds()
    for batch in batches:
        yield pa.array([properties(batch[i].as_py() or "", kinds) for i in range(len(batch))], pa.list_(pa.float64()))


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_labels: int = MAX_LABELS) -> Logistic:
    """The logistic model of the labelled documents; rows without a label, a text or words take no part.

    A key with several labels takes part with each. About ``max_labels`` labels are used: all if there are no more,
    otherwise those whose key hash is small enough.
    """
    marks = labels.select(F.col(key).alias("key"), F.col(label).alias("good")).dropna()
    n = marks.count()
    if n > max_labels:
        marks = marks.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.lit(int(max_labels / n * (1 << 30))))
    # the sample is bounded by max_labels, and so is what is broadcast
    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text")).join(F.broadcast(marks), "key").select(_properties("text").alias("x"), "good")
    found = rows.where("x is not null").toArrow()
    x = np.array(found.column("x").to_pylist(), np.float64).reshape(-1, len(PROPERTIES))
    return Logistic(x, np.array(found.column("good").to_pylist(), np.float64))


def log_odds_udf(spark: SparkSession, model: Logistic):
    """UDF: text to the log odds of being good."""
    shared = share(spark.sparkContext, model)

    @F.arrow_udf(T.DoubleType())
    def log_odds(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds, model = byte_kinds(), shared()
        for batch in batches:
            rows = [properties(batch[i].as_py() or "", kinds) for i in range(len(batch))]
            out = np.full(len(rows), WITHOUT_WORDS)
            with_words = [i for i, x in enumerate(rows) if x is not None]
            if with_words:
                out[with_words] = model.log_odds(np.array([rows[i] for i in with_words]))
            yield pa.array(out)
        hand_back_memory()

    return log_odds


def _strength(groups: DataFrame, mean: str) -> Column:
    """Prior strength from the spread of group means around ``mean`` beyond what their sizes explain (moments)."""
    spread = F.sum(F.col("n") * (F.col("good") / F.col("n") - F.col(mean)) ** 2) - F.sum(F.col(mean) * (1 - F.col(mean)) * F.least(F.lit(1.0), F.col("n")))
    total = F.sum(F.col(mean) * (1 - F.col(mean)) * F.greatest(F.col("n") - 1, F.lit(0)))
    return F.least(F.greatest(F.coalesce(F.try_divide(total, F.greatest(spread, F.lit(1e-9))), F.lit(1.0)), F.lit(1.0)), F.lit(1e4))


def posteriors(scored: DataFrame, host: str, path: str) -> DataFrame:
    """Per host and path: documents, sum of chances, and what they are shrunk toward, from all rows of ``scored``."""
    chance = 1 / (1 + F.exp(-F.col("log_odds")))
    paths = stored(scored.groupBy(F.col(host).alias("host"), F.col(path).alias("path")).agg(F.count("*").cast("double").alias("n"), F.sum(chance).alias("good")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    overall = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    mean = overall["good"] / overall["n"] if overall["n"] else 0.5
    hosts = hosts.withColumn("mean", F.lit(mean))
    host_strength = hosts.agg(_strength(hosts, "mean").alias("k")).first()["k"] or 1.0
    hosts = hosts.select("host", ((F.col("good") + host_strength * mean) / (F.col("n") + host_strength)).alias("host_posterior"))
    below = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    path_strength = below.agg(_strength(below, "host_posterior").alias("k")).first()["k"] or 1.0
    return stored(below.withColumn("strength", F.lit(float(path_strength))), "quality-posteriors")


def classified(docs: DataFrame, model: Logistic, host: str = "source", path: str = "lang", text: str = "text") -> DataFrame:
    """``docs`` with ``log_odds`` (own evidence), ``host_posterior``, ``path_posterior``, ``quality_score`` (0 to 1).

    The path's posterior leaves the document itself out. Null host or path is a group of its own. A text without words
    (null, empty, blank) scores next to 0. Every row counts, repeated ones too; all columns and rows are kept, columns
    named as the new ones are replaced. The text is read twice, for the sums and for the scores; no text is shuffled
    unless there are more than ``BROADCAST_ROWS`` paths.
    """
    scored = docs.withColumn("log_odds", log_odds_udf(docs.sparkSession, model)(text))
    groups = posteriors(scored.select(host, path, "log_odds"), host, path)
    groups = groups.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("n").alias("_n"), F.col("good").alias("_good"), F.col("host_posterior").alias("_prior"), F.col("strength").alias("_k"))
    if groups.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    joined = scored.join(groups, F.col(host).eqNullSafe(F.col("_host")) & F.col(path).eqNullSafe(F.col("_path")), "left")
    chance = 1 / (1 + F.exp(-F.col("log_odds")))
    others = (F.col("_good") - chance + F.col("_k") * F.col("_prior")) / (F.col("_n") - 1 + F.col("_k"))
    site = F.least(F.greatest(others, F.lit(1e-6)), F.lit(1 - 1e-6))
    base = math.log(model.share / (1 - model.share))
    return (
        joined.withColumn("host_posterior", F.col("_prior"))
        .withColumn("path_posterior", site)
        .withColumn("quality_score", 1 / (1 + F.exp(-(F.col("log_odds") - F.lit(base) + F.ln(F.col("path_posterior") / (1 - F.col("path_posterior")))))))
        .drop("_host", "_path", "_n", "_good", "_prior", "_k")
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, and whether it is kept (score of 0.5 or more)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    scored = classified(docs, model)
    return scored.select("doc_id", "log_odds", "host_posterior", "path_posterior", "quality_score", (F.col("quality_score") >= 0.5).alias("kept"))


ship_with_tasks(__name__)
