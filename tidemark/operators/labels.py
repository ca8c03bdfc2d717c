"""Churn labels. All of them reduce activity to one row per member before any join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import attach, flag, month_start
from tidemark.functions.stats import as_rows
from tidemark.settings import Settings

ID = "loyalty_number"


def activity_date() -> Column:
    return month_start(F.col("year"), F.col("month"))


def by_date(date: str) -> Column:
    """Months that begin by the date; on the year too, so that a scan can skip by it."""
    day = F.lit(date).cast("date")
    return (F.col("year") <= F.year(day)) & (activity_date() <= day)


def after_date(date: str) -> Column:
    day = F.lit(date).cast("date")
    return (F.col("year") >= F.year(day)) & (activity_date() > day)


def hard_churn(since_year: int | None) -> Column:
    cancelled = F.col("cancellation_year").isNotNull()
    if since_year is not None:
        cancelled = cancelled & (F.col("cancellation_year") >= since_year)
    return flag(cancelled)


def prediction_date(activity: DataFrame, months_before_end: int = 3) -> DataFrame:
    """One row: last month in the data and the date `months_before_end` earlier."""
    return activity.agg(F.max(activity_date()).alias("last_date")).select(
        "last_date", F.add_months("last_date", -months_before_end).alias("prediction_date")
    )


def churn_labels(members: DataFrame, activity: DataFrame, settings: Settings) -> DataFrame:
    """Hard churn, no flights in the label year, and either of them. No rows count as no flights."""
    flown = (
        activity.where(F.col("year") == settings.label_year)
        .groupBy(ID)
        .agg(F.sum("total_flights").alias("label_year_flights"))
    )
    return put_labels(members.join(flown, ID, "left"), settings)


def put_labels(members: DataFrame, settings: Settings) -> DataFrame:
    """The labels of members whose `label_year_flights` is there, NULL without rows."""
    return (
        members
        .withColumns({
            "hard_churn": hard_churn(settings.hard_churn_year),
            "label_year_flights": F.coalesce("label_year_flights", F.lit(0)),
        })
        .withColumn("activity_churn", flag(F.col("label_year_flights") == 0))
        .withColumn("churned", F.greatest("hard_churn", "activity_churn"))
    )


def last_activity(
    activity: DataFrame, until: str | None, active_only: bool = False
) -> DataFrame:
    """Last recorded month per member, optionally up to a date and over months with flights."""
    rows = activity
    if until is not None:
        rows = rows.where(by_date(until))
    if active_only:
        rows = rows.where(F.col("total_flights") > 0)
    return rows.groupBy(ID).agg(F.max(activity_date()).alias("last_activity_date"))


def record_window_labels(
    members: DataFrame,
    activity: DataFrame,
    date: str,
    months: tuple[int, ...] = (6, 12),
    combine_months: int = 6,
    cutoff_filter: bool = True,
    active_only: bool = False,
) -> DataFrame:
    """Churn by the age of the last record at `date`, or by having none; `churn` joins the
    `combine_months` window with any cancellation. `cutoff_filter=False` reads later rows too."""
    last = last_activity(activity, date if cutoff_filter else None, active_only)
    return put_window_labels(members.join(last, ID, "left"), date, months, combine_months)


def put_window_labels(members: DataFrame, date: str, months: tuple[int, ...] = (6, 12), combine_months: int = 6) -> DataFrame:
    """The same labels of members whose `last_activity_date` is there, NULL without records."""
    cutoff = {m: F.add_months(F.lit(date).cast("date"), -m) for m in {*months, combine_months}}
    silent = {
        f"activity_churn_{m}m": flag(
            F.col("last_activity_date").isNull() | (F.col("last_activity_date") < cutoff[m])
        )
        for m in cutoff
    }
    return (
        members
        .withColumns({"hard_churn": hard_churn(None), **silent})
        .withColumn("churn", F.greatest("hard_churn", f"activity_churn_{combine_months}m"))
    )


def fallback_labels(
    members: DataFrame, activity: DataFrame, months: int = 6, include_hard: bool = True
) -> DataFrame:
    """`churn`: last record more than `months` before the end of the data, or no record."""
    last = activity.groupBy(ID).agg(F.max(activity_date()).alias("last_activity_date"))
    ends = activity.agg(F.add_months(F.max(activity_date()), -months).alias("_cutoff"))
    silent = flag(
        F.col("last_activity_date").isNull() | (F.col("last_activity_date") < F.col("_cutoff"))
    )
    joined = attach(members.join(last, ID, "left"), ends)
    label = F.greatest(silent, hard_churn(None)) if include_hard else silent
    return joined.withColumn("churn", label).drop("_cutoff")


def sane_labels(
    labelled: DataFrame, label: str, fallback: str, low: float = 0.02, high: float = 0.90
) -> DataFrame:
    """Keep `label` unless its rate over the whole table is outside [low, high]; then take
    `fallback`. The rate is a one-row aggregate, so no action runs here."""
    rate = labelled.agg(F.avg(label).alias("label_rate"))
    usable = F.col("label_rate").between(low, high)
    return attach(labelled, rate).withColumn(
        label, F.when(usable, F.col(label)).otherwise(F.col(fallback))
    )


def churn_overlap(labelled: DataFrame, activity_label: str = "activity_churn") -> DataFrame:
    hard, silent = F.col("hard_churn") == 1, F.col(activity_label) == 1
    return labelled.agg(
        F.count_if(hard & ~silent).alias("hard_only"),
        F.count_if(~hard & silent).alias("activity_only"),
        F.count_if(hard & silent).alias("both"),
        F.count_if(~hard & ~silent).alias("neither"),
    )


def churn_definitions(labelled: DataFrame, definitions: dict[str, tuple[str, str]]) -> DataFrame:
    """`definition, churned, rate, description`; `{definition: (label column, description)}`."""
    wide = labelled.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(c) for c, _ in definitions.values()]
    )
    return as_rows(
        wide,
        {
            name: (F.col(c), F.col(c) * 100.0 / F.col("_rows"), F.lit(text))
            for name, (c, text) in definitions.items()
        },
        ["definition", "churned", "rate", "description"],
    )


def later_activity(activity: DataFrame, date: str) -> DataFrame:
    """Members with rows after `date`, one row each."""
    return (
        activity.where(after_date(date))
        .groupBy(ID)
        .agg(F.count(F.lit(1)).alias("later_rows"), F.max(activity_date()).alias("latest"))
    )


def leaking_members(
    labelled: DataFrame, activity: DataFrame, date: str, label: str = "churned"
) -> DataFrame:
    """Churned members that still have activity after the prediction date, over all members."""
    churned = labelled.where(F.col(label) == 1)
    return churned.join(later_activity(activity, date), ID, "left_semi")
