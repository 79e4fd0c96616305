"""A corpus from raw documents to packed sequences: five stages, each an operator of ``stockloom.llm``.

Each stage takes what the one before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import op4_packing, op5_quality, op6_lines, op8_jaccard, op10_language
from stockloom.llm.common import stored, table

QUALITY, LANGUAGE_SCORE, KNOWN = 0.5, 0.3, 0.5
BROADCAST_ROWS = 1_000_000
ROW_KEY = "_row_key"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least ``QUALITY``. The model is fitted on the labels of these documents."""
    model = op5_quality.fitted(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("_row"), "text", "source", "lang")
    return op5_quality.classified(rows, model).where(F.col("quality_score") >= QUALITY).select("_row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with a score of at least ``LANGUAGE_SCORE`` and known in it to ``KNOWN``.

    The score compares the learned languages with each other only; what is known of a text (words, long n-grams) tells other
    languages and noise. A text that the model learned from under a wrong label is known by its own words.
    """
    model = op10_language.fitted(docs.where(~op10_language.held_out()))
    rows = op10_language.predicted(docs.select(F.struct("*").alias("_row"), "text"), model, known="known")
    sure = (F.col("lang_pred") != op10_language.UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE) & (F.col("known") >= KNOWN)
    return rows.where(sure).select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; runs of lines that an earlier document has are deleted from the later ones."""
    out = op6_lines.deduplicated(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that is alike in 80 % of its five-word shingles: the one with the smallest id.

    Rows are told apart by a key of their own, so repeated rows are copies of each other, and rows that share an id but
    not their text stand for themselves. Null ids come last; of equal ids one row stays.
    """
    rows = stored(docs.withColumn(ROW_KEY, F.monotonically_increasing_id()), "keyed")
    groups = op8_jaccard.linked(rows, ROW_KEY).select(F.col("doc_id").alias(ROW_KEY), F.col("component_id").alias("group"))
    others = stored(groups.where(F.col("group") != F.col(ROW_KEY)), "group-members")
    members = others.union(others.select("group", "group").distinct()).join(rows.select(ROW_KEY, "doc_id"), ROW_KEY)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW_KEY))[ROW_KEY]
    survivors = members.groupBy("group").agg(first.alias(ROW_KEY)).select(ROW_KEY)
    copies = stored(members.select(ROW_KEY).join(survivors, ROW_KEY, "left_anti"), "copies")
    if copies.count() <= BROADCAST_ROWS:
        copies = F.broadcast(copies)
    return rows.join(copies, ROW_KEY, "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: pieces of documents with their ids."""
    import public_tokenizers

    return op4_packing.pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
