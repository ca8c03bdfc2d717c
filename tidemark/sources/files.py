"""File sources and sinks. Readers take a schema, so no pass over the data is spent on inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.columns import normalise_headers


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headers may be in any spelling and order: they are normalised, and columns are taken by the names of `schema`.

    A column that the file lacks is an error; a value that is not of its type reads as NULL.
    """
    found = normalise_headers(spark.read.csv(path, header=True, enforceSchema=False))
    missing = [f.name for f in schema.fields if f.name not in found.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return found.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, document: bool = False
) -> DataFrame:
    """JSON lines; with `document`, each file is one document on any number of lines."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path, multiLine=document)


def path_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Ask the file system that owns the path, through the reader itself."""
    probe = T.StructType([T.StructField("probe", T.StringType())])
    try:
        spark.read.schema(probe).format(fmt).load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_optional(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """The table at `path`, or an empty table of the same schema."""
    if path_exists(spark, path, fmt):
        return spark.read.schema(schema).options(**options).format(fmt).load(path)
    return spark.createDataFrame([], schema)


def read_first_existing(
    spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", **options: str
) -> DataFrame:
    """The first of an ordered list of places that exists."""
    for path in paths:
        if path_exists(spark, path, fmt):
            return spark.read.options(**options).format(fmt).load(path)
    raise FileNotFoundError(f"none of {list(paths)} exists")
