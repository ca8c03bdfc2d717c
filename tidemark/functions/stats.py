"""Scaling, distribution and association tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import attach
from tidemark.functions.ranks import quantile_row, quantiles


def minmax(x: Column, low: Column, high: Column) -> Column:
    """0..1; a constant column gives 0."""
    return F.when(high > low, (x - low) / (high - low)).otherwise(F.lit(0.0) * x)


def standardised(x: Column, mean: Column, std: Column) -> Column:
    """Population z-score; a constant column gives 0."""
    return (x - mean) / F.when(std > 0, std).otherwise(F.lit(1.0))


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(
        *[F.min(c).cast("double").alias(f"{c}__min") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}__max") for c in columns],
    )


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
    )


def minmax_scale(df: DataFrame, columns: Sequence[str], fitted: DataFrame | None = None) -> DataFrame:
    kept = [c for c in df.columns if c not in columns]
    with_ranges = attach(df, fitted if fitted is not None else ranges(df, columns))
    return with_ranges.select(
        *kept, *[minmax(F.col(c), F.col(f"{c}__min"), F.col(f"{c}__max")).alias(c) for c in columns]
    )


def standard_scale(df: DataFrame, columns: Sequence[str], fitted: DataFrame | None = None) -> DataFrame:
    kept = [c for c in df.columns if c not in columns]
    with_moments = attach(df, fitted if fitted is not None else moments(df, columns))
    return with_moments.select(
        *kept,
        *[standardised(F.col(c), F.col(f"{c}__mean"), F.col(f"{c}__std")).alias(c) for c in columns],
    )


def median_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL -> the exact column median, all columns in one pass."""
    medians = quantile_row(df, {f"{c}__median": (c, 0.5) for c in columns})
    filled = {c: F.coalesce(F.col(c), F.col(f"{c}__median")) for c in columns}
    return attach(df, medians).withColumns(filled).select(*df.columns)


def winsorise(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    limits = quantile_row(df, {"_low": (column, low), "_high": (column, high)})
    x = F.col(column)
    limited = F.when(x.isNotNull(), F.least(F.greatest(x, F.col("_low")), F.col("_high")))
    return attach(df, limits).withColumn(column, limited).drop("_low", "_high")


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """`by..., bin, bin_low, bin_high, members, density`; the last bin holds its upper edge.
    Bins span the whole column's range, so the groups can be laid over each other."""
    x = F.col(column)
    spans = df.agg(
        F.min(column).cast("double").alias("_low"), F.max(column).cast("double").alias("_high")
    )
    width = F.when(F.col("_high") > F.col("_low"), (F.col("_high") - F.col("_low")) / bins).otherwise(1.0)
    number = F.least(F.floor((x - F.col("_low")) / F.col("_width")), F.lit(bins - 1)).cast("long")
    counted = (
        attach(df.where(x.isNotNull()), spans.select("_low", width.alias("_width")))
        .groupBy(*by, "_low", "_width", number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("members"))
    )
    sizes = counted.groupBy(*by).agg(F.sum("members").alias("_size"))
    sized = counted.join(sizes, list(by)) if by else attach(counted, sizes)
    edge = F.col("_low") + F.col("bin") * F.col("_width")
    return sized.select(
        *by, "bin", edge.alias("bin_low"), (edge + F.col("_width")).alias("bin_high"), "members",
        (F.col("members") / (F.col("_size") * F.col("_width"))).alias("density"),
    )


def box_plot(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, whiskers (furthest value within 1.5 IQR) and outlier count per group."""
    wanted = {"q1": (column, 0.25), "median": (column, 0.5), "q3": (column, 0.75)}
    quartiles = quantiles(df, wanted, [by]).select(F.col(by).alias("_by"), *wanted)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(column)
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        df.select(by, column)
        .join(quartiles, F.col(by).eqNullSafe(F.col("_by")))
        .groupBy(by)
        .agg(
            *[F.first(q).alias(q) for q in wanted],
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def correlation_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """`feature, correlation` with the target in one aggregate, strongest first."""
    wide = df.agg(*[F.corr(F.col(c), F.col(target)).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "correlation").orderBy(
        F.abs("correlation").desc_nulls_last(), "feature"
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`row_feature, column_feature, correlation` for every pair, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(F.col(a), F.col(b)).alias(f"{a}__{b}") for a, b in pairs])
    entries = [
        F.struct(F.lit(a).alias("row_feature"), F.lit(b).alias("column_feature"),
                 F.col(f"{min_first}").alias("correlation"))
        for a in columns for b in columns
        for min_first in [f"{a}__{b}" if columns.index(a) <= columns.index(b) else f"{b}__{a}"]
    ]
    return wide.select(F.inline(F.array(*entries)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max: one row per column."""
    basics = df.agg(*[
        F.expr(f"{fn}(double(`{c}`)) AS `{c}__{name}`")
        for c in columns
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
    ])
    parts = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    quartiles = quantiles(df, {f"{c}__{name}": (c, p) for c in columns for name, p in parts.items()})
    shown = ["mean", "std", "min", "max", *parts]
    entries = {c: (F.col(f"{c}__n"), *[F.col(f"{c}__{name}") for name in shown]) for c in columns}
    return as_rows(attach(basics, quartiles), entries, ["column", "count", *shown])


def null_profile(df: DataFrame) -> DataFrame:
    """`column, missing, percent`: one pass, one row per column."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    return wide.unpivot(["_rows"], list(df.columns), "column", "missing").select(
        "column", "missing",
        F.coalesce(F.try_divide(F.col("missing") * 100.0, F.col("_rows")), F.lit(0.0)).alias("percent"),
    )


def shares(df: DataFrame, by: str) -> DataFrame:
    """Frequency table with each level's share of all rows, in percent."""
    counted = df.groupBy(by).agg(F.count(F.lit(1)).alias("members"))
    total = counted.agg(F.sum("members").alias("_total"))
    return attach(counted, total).select(
        by, "members", (F.col("members") * 100.0 / F.col("_total")).alias("percent")
    )


def as_rows(wide: DataFrame, entries: Mapping[str, Sequence], names: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate into labelled rows: `{label: (column, ...)}` -> `names`."""
    structs = [
        F.struct(F.lit(label).alias(names[0]), *[c.alias(n) for c, n in zip(cols, names[1:])])
        for label, cols in entries.items()
    ]
    return wide.select(F.inline(F.array(*structs)))
