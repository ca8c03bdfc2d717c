"""Helpers that work on the schema only: header names, column choice, column fallback."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def find_column(columns: Iterable[str], *keywords: str) -> str | None:
    """First column whose name holds every keyword, whatever the case."""
    wanted = [k.lower() for k in keywords]
    return next((c for c in columns if all(k in c.lower() for k in wanted)), None)


def feature_columns(df: DataFrame, excluded: Iterable[str]) -> list[str]:
    """Numeric columns that are neither ids nor labels."""
    left_out = set(excluded)
    return [c for c in numeric_columns(df) if c not in left_out]


def preferred_columns(
    df: DataFrame, preferred: Sequence[str], excluded: Iterable[str], minimum: int = 8
) -> list[str]:
    """The preferred columns that exist, topped up to `minimum` with other numeric columns."""
    chosen = [c for c in preferred if c in df.columns]
    spare = [c for c in feature_columns(df, excluded) if c not in chosen]
    return chosen + spare[: max(0, minimum - len(chosen))]


def align_columns(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly `keep` then `wanted`; a wanted column that is missing becomes 0."""
    filled = [F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in wanted]
    return df.select(*keep, *filled)


def with_default(df: DataFrame, name: str, make: Callable[[], Column]) -> DataFrame:
    """Add a column only where it is absent."""
    return df if name in df.columns else df.withColumn(name, make())
