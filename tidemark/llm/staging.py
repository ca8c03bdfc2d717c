"""Staged tables and blocks of rows, in the folder that the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def staged(df: DataFrame) -> DataFrame:
    """The frame written as a table in the shared folder, and read from there.

    What follows reads finished files, so a lost executor costs a re-read and no second run of the steps
    before, and values that depend on the order of rows stay as they were written.
    """
    return staged_in_turn([df])


def staged_in_turn(frames: Iterable[DataFrame]) -> DataFrame:
    """The rows of one frame or more as a staged table; each frame is written before the next one is asked for."""
    path = None
    for df in frames:
        path = path or f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
        df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Jobs inside run under these settings; the session's own return."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20, rows: int = 512) -> Iterator[None]:
    """Jobs inside hand Arrow batches of about `size` bytes to Python and read Parquet in `rows` rows; the session's own settings return.

    A batch is held by the JVM as vectors and as the stream to the worker, each with room to grow, and by the worker: ten thousand
    long texts at once are several times their size in each task. A longer row is a batch of its own.
    """
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(size), "spark.sql.parquet.columnarReaderBatchSize": str(rows)}):
        yield


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    while name in docs.columns:
        name += "_"
    return name


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]
