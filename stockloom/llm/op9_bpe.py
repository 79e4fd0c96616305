"""Encoding and decoding by byte-level BPE with a contiguous rank array (see ``bpe``).

The model (a few MB, its size fixed by the vocabulary) is read once on the driver and broadcast. Each row is encoded in
the task that reads it; nothing is shuffled, and a task holds one Arrow batch, worked on in slices of about 4 MB of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm.bpe import TextEncoder, gathered, slices
from stockloom.llm.common import table
from stockloom.shipping import share, ship_with_tasks


def encode_udf(spark: SparkSession, tokenizer_file: str):
    """UDF: text to its ids; null for null."""
    model = share(spark.sparkContext, TextEncoder(Path(tokenizer_file).read_text()))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = model()
        for batch in batches:
            runs = [encoder.encode(run) for run in slices(batch)]
            sizes = np.concatenate([np.zeros(0, np.int64), *[np.diff(ends) for _, ends in runs]])
            values = pa.array(np.concatenate([np.zeros(0, "<i4"), *[flat.view("<i4") for flat, _ in runs]]))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            missing = np.append(batch.is_null().to_numpy(zero_copy_only=False), False)
            yield pa.ListArray.from_arrays(pa.array(offsets, mask=missing), values)

    return encode


def decode_udf(spark: SparkSession, tokenizer_file: str):
    """UDF: ids to their text, special tokens included; bytes that are no UTF-8 become U+FFFD; null for null."""
    model = share(spark.sparkContext, Pieces(TextEncoder(Path(tokenizer_file).read_text())))

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = model()
        for batch in batches:
            yield pa.array([None if x is None else pieces.text(np.array(x, np.int64)) for x in (batch[i].as_py() for i in range(len(batch)))], pa.string())

    return decode


class Pieces:
    """The bytes that ids stand for, end to end."""

    def __init__(self, encoder: TextEncoder) -> None:
        self.encoder = encoder
        self.size = np.array([len(x) for x in encoder.merges.pieces])
        self.bytes = np.frombuffer(b"".join(encoder.merges.pieces), np.uint8)

    def text(self, ids: np.ndarray) -> str:
        return gathered(self.bytes, self.size, ids)[0].tobytes().decode("utf-8", "replace")


def digest_udf(spark: SparkSession, tokenizer_file: str):
    """UDF: text to the number of its ids, their digest, and the digest of the text decoded from them. Null is empty."""
    model = share(spark.sparkContext, Pieces(TextEncoder(Path(tokenizer_file).read_text())))

    @F.arrow_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = model()
        for batch in batches:
            counts, ids_digest, text_digest = [], [], []
            for run in slices(batch):
                flat, ends = pieces.encoder.encode(run)
                counts += np.diff(ends).tolist()
                for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    ids = flat[start:end]
                    ids_digest.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    text_digest.append(hashlib.sha256(pieces.text(ids).encode()).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def encoded(docs: DataFrame, tokenizer_file: str, text: str | Column = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts. Null text: null ids; empty text: no ids. Every row is encoded by itself, so
    repeated rows, empty tables and further columns need no care."""
    return docs.withColumn(ids, encode_udf(docs.sparkSession, tokenizer_file)(text))


def decoded(docs: DataFrame, tokenizer_file: str, ids: str | Column = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text that its ids stand for."""
    return docs.withColumn(text, decode_udf(docs.sparkSession, tokenizer_file)(ids))


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of every whole text of ``documents``."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = digest_udf(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return docs.withColumn("d", digest("text")).select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


ship_with_tasks(__name__)
