"""Results that several later jobs read, written once to shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for a local session without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="stockloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative model fits cut their lineage in the checkpoint folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a write inside has shuffled is deleted when it ends, and not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    A lost executor then costs a re-read, not a recomputation, later plans prune columns on the file, and the true file
    size lets the optimiser decide about broadcasting. Nothing that the write has shuffled is needed after it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(*tables: DataFrame) -> None:
    """Delete written intermediate tables that nothing reads any more."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            drop_folder(df.sparkSession, file.rsplit("/", 1)[0])


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results, wherever it is stored; nothing happens if it is gone."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
