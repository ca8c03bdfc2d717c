"""Cleaning and imputation of the member and activity tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions.exprs import at_least, attach, flag, month_start
from tidemark.functions.ranks import quantile_row
from tidemark.functions.stats import as_rows, median_fill
from tidemark.sources.columns import find_column, numeric_columns, string_columns

CANCELLATION = ("cancellation_year", "cancellation_month")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """The row with the smallest `order_by` per key; NULL comes last, and ties go by the other columns.
    Without `order_by` all columns in turn are the order.

    The minimum of one struct combines before the shuffle, so many copies of one key never meet in
    one task as they would in a `row_number` window, and its fields come from one row.
    """
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.distinct()
    lead = [] if order_by is None else [F.col(order_by).isNull().alias("_late"), F.col(order_by).alias("_order")]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*lead, *payload)).alias("_first"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_first.`{c}`").alias(c) for c in df.columns])


def member_statistics(members: DataFrame) -> DataFrame:
    """One row: the quantiles the member columns are built with."""
    return quantile_row(members, {"salary_median": ("salary", 0.5), "high_clv": ("clv", 0.75)})


def fill_salary(members: DataFrame, statistics: DataFrame | Row | None = None) -> DataFrame:
    """Flag missing salaries, then put the median (taken before any fix) where the salary is
    missing or negative."""
    if statistics is None:
        statistics = member_statistics(members)
    salary, median = F.col("salary"), F.col("salary_median")
    return (
        attach(members, statistics, ["salary_median"])
        .withColumns({
            "salary_missing": flag(salary.isNull()),
            "salary": F.when(salary.isNull() | (salary < 0), median).otherwise(salary),
        })
        .drop("salary_median")
    )


def fill_unknown(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.fillna("Unknown", subset=list(columns or string_columns(df)))


def fill_medians(df: DataFrame, exclude: Iterable[str] = CANCELLATION) -> DataFrame:
    """Every numeric column except `exclude`: an absent cancellation means "not cancelled"."""
    left_out = set(exclude)
    return median_fill(df, [c for c in numeric_columns(df) if c not in left_out])


def fix_clv(df: DataFrame, column: str = "clv") -> DataFrame:
    """Values at or under 0 become 1, then the log column is added."""
    fixed = F.when(F.col(column) <= 0, 1.0).otherwise(F.col(column))
    return df.withColumn(column, fixed).withColumn("clv_log", F.log1p(column))


def clamp_age(df: DataFrame, low: int = 18, high: int = 100) -> DataFrame:
    """Bound the age column, where the table has one."""
    name = find_column(df.columns, "age")
    if name is None:
        return df
    x = F.col(name)
    return df.withColumn(name, F.when(x < low, low).when(x > high, high).otherwise(x))


def clean_members(members: DataFrame, id_column: str = "loyalty_number") -> DataFrame:
    """One row per member; Unknown for missing text, medians for missing numbers, positive CLV with its log."""
    single = keep_first(members, [id_column])
    filled = fill_medians(fill_unknown(single), exclude=(id_column, *CANCELLATION))
    return fix_clv(filled)


def clean_activity(
    activity: DataFrame, measures: Sequence[str], order_by: str | None = None
) -> DataFrame:
    """Add the month's date, keep one row per member and month, and no NULL or negative measure.

    `order_by` says which duplicate is the first; without it all columns in turn do.
    """
    keyed = keep_first(activity, ["loyalty_number", "year", "month"], order_by)
    repaired: dict[str, Column] = {m: at_least(F.coalesce(F.col(m), F.lit(0)), 0) for m in measures}
    return keyed.withColumns(repaired).withColumn(
        "activity_date", month_start(F.col("year"), F.col("month"))
    )


def quarter_map(calendar: DataFrame) -> DataFrame:
    """Distinct `year, month, quarter` of a daily calendar."""
    day = F.col("date").cast("date")
    return calendar.select(
        F.year(day).alias("year"), F.month(day).alias("month"), F.quarter(day).alias("quarter")
    ).distinct()


def cleaning_log(members: DataFrame, activity: DataFrame, id_column: str = "loyalty_number") -> DataFrame:
    """`step, dataset, column, method, count` of what cleaning will change; steps that change
    nothing are left out."""
    text = string_columns(members)
    numbers = [c for c in numeric_columns(members) if c not in (id_column, *CANCELLATION)]
    wide = members.agg(
        (F.count(F.lit(1)) - F.count_distinct(id_column)).alias("duplicates"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in [*text, *numbers]],
        F.count_if(F.col("clv") <= 0).alias("low_clv"),
    )
    none = F.lit(None).cast("string")
    entries = [("remove_duplicates", none, none, F.col("duplicates"))]
    entries += [("fill_missing", F.lit(c), F.lit("Unknown"), F.col(c)) for c in text]
    entries += [("fill_missing", F.lit(c), F.lit("median"), F.col(c)) for c in numbers]
    entries += [("fix_negative_clv", none, none, F.col("low_clv"))]
    member_log = wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(step).alias("step"), F.lit("loyalty").alias("dataset"), column.alias("column"),
            method.alias("method"), count.alias("count"),
        )
        for step, column, method, count in entries
    ])))
    activity_log = key_duplicates(activity, ["loyalty_number", "year", "month"]).select(
        F.lit("remove_duplicates").alias("step"), F.lit("activity").alias("dataset"),
        none.alias("column"), none.alias("method"), F.col("duplicates").alias("count"),
    )
    return member_log.unionByName(activity_log).where(F.col("count") > 0)


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: `rows`, `distinct_keys`, `duplicates`. Counting per key first keeps it to one
    pre-aggregated shuffle."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
    )


def duplicate_audit(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """`dataset, rows, distinct_keys, duplicates` for each table and key list."""
    parts = [
        key_duplicates(df, keys).select(F.lit(name).alias("dataset"), "*")
        for name, (df, keys) in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def quality_issues(members: DataFrame, activity: DataFrame) -> DataFrame:
    """`dataset, issue, severity, count` for the checks that find something."""
    checks = {
        "missing_values": (
            F.sum(sum(((F.col(c).isNull()).cast("long") for c in members.columns), F.lit(0))),
            "medium",
        ),
        "negative_clv": (F.count_if(F.col("clv") <= 0), "high"),
        "negative_salary": (F.count_if(F.col("salary") < 0), "low"),
    }
    age = find_column(members.columns, "age")
    if age is not None:
        checks["suspicious_ages"] = (F.count_if((F.col(age) < 18) | (F.col(age) > 100)), "low")
    wide = members.agg(*[c.alias(name) for name, (c, _) in checks.items()])
    found = as_rows(
        wide,
        {name: (F.lit(severity), F.col(name)) for name, (_, severity) in checks.items()},
        ["issue", "severity", "count"],
    ).select(F.lit("loyalty").alias("dataset"), "*")

    seen = activity.groupBy("loyalty_number").agg(F.count(F.lit(1)).alias("records"))
    cancelled = members.where(F.col("cancellation_year").isNotNull())
    leaks = cancelled.join(seen, "loyalty_number", "left_semi").agg(F.count(F.lit(1)).alias("count"))
    temporal = leaks.select(
        F.lit("both").alias("dataset"), F.lit("potential_temporal_leakage").alias("issue"),
        F.lit("high").alias("severity"), "count",
    )
    return found.unionByName(temporal).where(F.col("count") > 0)


def validation_checks(
    members: DataFrame, activity: DataFrame, nullable: Sequence[str] = CANCELLATION
) -> DataFrame:
    """`check, failures, passed` over cleaned tables."""
    def nulls(df: DataFrame, name: str) -> DataFrame:
        per_row = sum(
            (F.col(c).isNull().cast("long") for c in df.columns if c not in nullable), F.lit(0)
        )
        return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("failures")).select(
            F.lit(name).alias("check"), "failures"
        )

    def copies(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        return key_duplicates(df, keys).select(
            F.lit(name).alias("check"), F.col("duplicates").alias("failures")
        )

    checks = (
        nulls(members, "loyalty_missing")
        .unionByName(nulls(activity, "activity_missing"))
        .unionByName(copies(members, members.columns, "loyalty_duplicate_rows"))
        .unionByName(copies(activity, ["loyalty_number", "year", "month"], "activity_duplicates"))
    )
    return checks.withColumn("passed", flag(F.col("failures") == 0))
