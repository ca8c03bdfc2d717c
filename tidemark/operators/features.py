"""Behaviour features: one aggregation of activity per variant, one join to members.

Conditional sums replace the usual filter-group-join chains, so every variant reads activity
once and shuffles one partial row per member and task. Activity holds one row per member and
month (see `cleaning.clean_activity`), so counting rows counts months.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions.exprs import EPSILON, at_least, attach, clip, flag, lookup, months_since_zero
from tidemark.functions.stats import minmax, ranges
from tidemark.operators.cleaning import fill_salary, member_statistics
from tidemark.operators.labels import ID, activity_date, by_date, prediction_date, put_labels, put_window_labels
from tidemark.session import cut_lineage
from tidemark.settings import Settings

DAYS_PER_MONTH = 30.44


def _sum_when(condition: Column, x: str = "total_flights") -> Column:
    return F.sum(F.when(condition, F.col(x)))


def _zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0))


def in_year(activity: DataFrame, year: int) -> DataFrame:
    return activity.where(F.col("year") == year)


def until(activity: DataFrame, date: str) -> DataFrame:
    """Rows of months that begin by `date`. Written on year and month as well, so the scan can
    skip partitions and row groups."""
    day = F.lit(date).cast("date")
    return activity.where((F.col("year") <= F.year(day)) & (activity_date() <= day))


def _programme_sums(settings: Settings, inside: Column | None = None) -> list[Column]:
    """Totals, means and shape per member of the rows that are `inside` (all rows without it)."""
    def at(x: str) -> Column:
        return F.col(x) if inside is None else F.when(inside, F.col(x))

    flights, month = at("total_flights"), F.col("month")

    def in_months(condition: Column) -> Column:
        return F.sum(F.when(condition, flights))

    last = at("month") if settings.recency_basis == "recorded" else F.when(flights > 0, month)
    return [
        F.sum(flights).alias("total_flights"),
        F.avg(flights).alias("avg_flights_per_month"),
        F.max(flights).alias("max_flights_month"),
        F.coalesce(F.stddev_samp(flights), F.lit(0.0)).alias("flight_std"),
        F.sum(at("distance")).alias("total_distance"),
        F.avg(at("distance")).alias("avg_distance_per_month"),
        F.sum(at("points_accumulated")).alias("total_points_accumulated"),
        F.sum(at("points_redeemed")).alias("total_points_redeemed"),
        F.avg(at("points_accumulated")).alias("avg_points_per_month"),
        F.sum(at("dollar_cost_points_redeemed")).alias("total_dollar_cost_redeemed"),
        F.count_if(flights > 0).alias("active_months"),
        F.count(flights).alias("months_recorded"),
        _zero(F.max(last)).alias("last_active_month"),
        # NULL when a half has no rows, hence 0 for a member seen in one half only
        _zero(in_months(month >= 7) - in_months(month <= 6)).alias("momentum_h2_minus_h1"),
        _zero(in_months(month >= 10)).alias("q4_flights"),
        _zero(in_months(month <= 3)).alias("q1_flights"),
    ]


def _programme_rates(base: DataFrame) -> DataFrame:
    earned, burned = F.col("total_points_accumulated"), F.col("total_points_redeemed")
    spread = F.col("flight_std") / (F.col("avg_flights_per_month") + EPSILON)
    return base.withColumns({
        "recency_months": at_least(12 - F.col("last_active_month"), 0),
        "active_month_ratio": F.col("active_months") / 12,
        "flight_consistency": 1 - clip(spread, 0, 1),
        "redemption_rate": clip(burned / (earned + EPSILON), 0, 1),
        "dollar_cost_per_flight": clip(
            F.col("total_dollar_cost_redeemed") / (F.col("total_flights") + EPSILON), 0
        ),
        "points_balance": clip(earned - burned, 0),
    })


def activity_features(activity: DataFrame, settings: Settings) -> DataFrame:
    """Totals, means and shape of the feature year per member."""
    base = in_year(activity, settings.feature_year).groupBy(ID).agg(*_programme_sums(settings))
    return _programme_rates(base)


def member_history(activity: DataFrame, settings: Settings) -> DataFrame:
    """`label_year_flights` and the feature year's features per member, from one aggregate over the two years.
    The features are NULL for a member without rows in the feature year."""
    feature, label = (F.col("year") == y for y in (settings.feature_year, settings.label_year))
    base = activity.where(feature | label).groupBy(ID).agg(
        F.sum(F.when(label, F.col("total_flights"))).alias("label_year_flights"),
        F.count_if(feature).alias("_rows"),
        F.struct(*_programme_sums(settings, feature)).alias("_year"),
    )
    rated = _programme_rates(base.select(ID, "label_year_flights", "_rows", "_year.*"))
    measured = [c for c in rated.columns if c not in (ID, "label_year_flights", "_rows")]
    return rated.select(
        ID, "label_year_flights", *[F.when(F.col("_rows") > 0, F.col(c)).alias(c) for c in measured]
    )


def encode_members(members: DataFrame, settings: Settings) -> DataFrame:
    """Encoded demographics and tenure: everything that needs the member's own row only."""
    year, month = map(int, settings.prediction_date.split("-")[:2])

    def same(column: str, value: str) -> Column:
        return F.lower(column) == value.lower() if settings.ignore_case else F.col(column) == value

    enrolled = months_since_zero(F.col("enrollment_year"), F.col("enrollment_month"))
    return members.withColumns({
        "tenure_months": at_least(F.lit(year * 12 + month) - enrolled, 0),
        "tier_numeric": lookup(F.col("loyalty_card"), settings.tier_levels, 1),
        "education_numeric": lookup(F.col("education"), settings.education_levels, 2),
        "is_female": flag(same("gender", "Female")),
        "is_married": flag(same("marital_status", "Married")),
        "is_promo_enrollment": flag(same("enrollment_type", settings.promo_label)),
        "clv_log": F.log1p("clv"),
        "is_early_member": flag(F.col("enrollment_year") <= settings.early_member_year),
        "is_recent_member": flag(F.col("enrollment_year") >= settings.recent_member_year),
        "province_code": lookup(F.col("province"), settings.province_codes, 0),
        **{name: flag(F.col("province") == p) for name, p in settings.province_flags.items()},
    })


def flag_high_clv(members: DataFrame, statistics: DataFrame | Row | None = None) -> DataFrame:
    """`has_high_clv`: above the 75th percentile of all members."""
    if statistics is None:
        statistics = member_statistics(members)
    above = flag(F.col("clv") > F.col("high_clv"))
    return attach(members, statistics, ["high_clv"]).withColumn("has_high_clv", above).drop("high_clv")


def member_features(members: DataFrame, settings: Settings) -> DataFrame:
    return flag_high_clv(encode_members(members, settings))


ENGAGEMENT_PARTS = (
    "recency_months", "active_month_ratio", "flight_consistency", "redemption_rate", "tier_numeric",
)


def engagement_minmax(
    features: DataFrame, name: str = "engagement_health_score", spans: DataFrame | Row | None = None
) -> DataFrame:
    """Mean of five min-max scaled parts, x 100.

    Recency is scaled, inverted and scaled again; that equals (max - x) / (max - min), and 0 for
    a constant column, so one pass for the ranges is enough.
    """
    def scaled(c: str) -> Column:
        low, high = F.col(f"{c}__min"), F.col(f"{c}__max")
        if c == "recency_months":
            return F.when(high > low, (high - F.col(c)) / (high - low)).otherwise(0.0)
        return minmax(F.col(c), low, high)

    mean = sum((scaled(c) for c in ENGAGEMENT_PARTS[1:]), scaled(ENGAGEMENT_PARTS[0])) / 5
    if spans is None:
        spans = ranges(features, ENGAGEMENT_PARTS)
    edges = [f"{c}__{edge}" for c in ENGAGEMENT_PARTS for edge in ("min", "max")]
    scored = attach(features, spans, edges).withColumn(name, F.round(mean * 100, 1))
    return scored.drop(*edges)


def engagement_weighted(features: DataFrame, name: str = "engagement_health_score") -> DataFrame:
    """25 points each for recency within 24 months, active months, consistency and redemption."""
    score = 25 * (
        (1 - clip(F.col("recency_months"), 0, 24) / 24)
        + clip(F.col("active_month_ratio"), 0, 1)
        + clip(F.col("flight_consistency"), 0, 1)
        + clip(F.col("redemption_rate"), 0, 1)
    )
    return features.withColumn(name, clip(score, 0, 100))


def engagement_additive(features: DataFrame, name: str = "engagement_score") -> DataFrame:
    """50 plus up to 20 for recency, consistency and redemption and 10 for trend and growth."""
    score = (
        50
        + 20 * (1 - clip(F.col("recency_days"), 0, 365) / 365)
        + 20 * F.col("consistency_score")
        + 20 * F.col("redemption_rate")
        + 10 * F.col("trend_direction")
        + 10 * clip(F.col("yoy_growth"), -1, 1)
    )
    return features.withColumn(name, clip(score, 0, 100))


def _matrix(joined: DataFrame, settings: Settings, measured: Sequence[str]) -> DataFrame:
    """Members joined with their features, 0 where the year is empty. The joined table is the only one written; the figures over
    all members are taken from it, so what follows is a scan and a projection."""
    encoded = encode_members(cut_lineage(joined.fillna(0, subset=list(measured))), settings)
    figures = attach(ranges(encoded, ENGAGEMENT_PARTS), member_statistics(encoded)).first()
    return flag_high_clv(fill_salary(engagement_minmax(encoded, spans=figures), figures), figures)


def feature_matrix(labelled: DataFrame, activity: DataFrame, settings: Settings) -> DataFrame:
    """One row per member: labels as they are, demographics, activity features (0 where the year is empty)
    and the engagement score."""
    behaviour = activity_features(activity, settings)
    return _matrix(labelled.join(behaviour, ID, "left"), settings, [c for c in behaviour.columns if c != ID])


def labelled_matrix(members: DataFrame, activity: DataFrame, settings: Settings) -> DataFrame:
    """The feature matrix with its churn labels, from one pass over activity."""
    history = member_history(activity, settings)
    measured = [c for c in history.columns if c not in (ID, "label_year_flights")]
    labelled = put_labels(members.join(history, ID, "left"), settings)
    order = [*members.columns, "hard_churn", "label_year_flights", "activity_churn", "churned", *measured]
    return _matrix(labelled.select(*order), settings, measured)


# --- features up to a date: recency, momentum, volatility, season, points, trajectory -----------


def trailing_features(activity: DataFrame, date: str) -> DataFrame:
    """Every feature group that looks back from `date`, in one aggregation."""
    day = F.lit(date).cast("date")
    at = activity_date()
    month = F.col("month")

    def since(months: int) -> Column:
        return at > F.add_months(day, -months)

    base = until(activity, date).groupBy(ID).agg(
        F.date_diff(day, F.max(at)).alias("recency_days"),
        F.sum("total_flights").alias("total_flights"),
        F.count(F.lit(1)).alias("active_months"),
        _zero(_sum_when(since(3))).alias("flights_3m"),
        _zero(_sum_when(since(6))).alias("flights_6m"),
        F.coalesce(F.stddev_samp("total_flights"), F.lit(0.0)).alias("std_flights"),
        F.avg("total_flights").alias("_mean_flights"),
        _zero(_sum_when(month.isin(6, 7, 8))).alias("_summer"),
        _zero(_sum_when(month.isin(11, 12, 1))).alias("_holiday"),
        F.sum("points_accumulated").alias("total_earned"),
        F.sum("points_redeemed").alias("total_redeemed"),
        _sum_when(since(12)).alias("_last_year"),
        _sum_when(since(24) & ~since(12)).alias("_year_before"),
    )
    trips = at_least(F.col("total_flights"), 1)
    earned, burned = F.col("total_earned"), F.col("total_redeemed")
    last, before = _zero(F.col("_last_year")), _zero(F.col("_year_before"))
    seen_lately = F.col("_last_year").isNotNull() | F.col("_year_before").isNotNull()
    growth = clip((last - before) / at_least(before, 1), -2, 5)
    return (
        base.withColumns({
            "avg_flights_mo": F.col("total_flights") / at_least(F.col("active_months"), 1),
            "momentum_ratio": clip(F.col("flights_3m") / at_least(F.col("flights_6m"), 1), 0, 5),
            "cv_flights": F.col("std_flights") / at_least(F.col("_mean_flights"), 0.01),
            "summer_ratio": F.col("_summer") / trips,
            "holiday_ratio": F.col("_holiday") / trips,
            "redemption_rate": clip(burned / at_least(earned, 1.0), 0, 1),
            "earn_burn_ratio": clip(earned / at_least(burned, 1.0), 0, 100),
            "points_balance": clip(earned - burned, 0),
            # a member without rows in either year has no trajectory
            "flights_ly": F.when(seen_lately, last),
            "flights_py": F.when(seen_lately, before),
            "yoy_growth": F.when(seen_lately, growth),
        })
        .withColumns({
            "trend_direction": flag(F.col("momentum_ratio") > 1),
            "consistency_score": 1 / (1 + F.col("cv_flights")),
            "seasonality_score": F.col("summer_ratio") + F.col("holiday_ratio"),
        })
        .drop("_mean_flights", "_summer", "_holiday", "_last_year", "_year_before")
    )


def trailing_matrix(labelled: DataFrame, activity: DataFrame, date: str, label: str = "churn") -> DataFrame:
    """Trailing features of the members seen by `date`, with CLV, additive score and label."""
    known = labelled.select(ID, "clv", label)
    # growth is NULL for members away for two years; their score becomes 0 with the rest
    scored = engagement_additive(trailing_features(activity, date).join(known, ID, "left"))
    return scored.fillna(0, subset=[c for c in scored.columns if c != label])


# --- features over all records, measured from a date -----------------------------------------------


def _record_sums(years: tuple[int, int]) -> list[Column]:
    month = F.col("month")
    first_year, second_year = years
    return [
        F.sum("total_flights").alias("total_flights"),
        F.sum("distance").alias("total_distance"),
        F.count(F.lit(1)).alias("active_months"),
        ((F.max("year") - F.min("year")) * 12 + F.max("month")).alias("months_recorded"),
        F.max("total_flights").alias("max_flights_month"),
        F.coalesce(F.stddev_samp("total_flights"), F.lit(0.0)).alias("flight_std"),
        F.sum("points_accumulated").alias("total_points_accumulated"),
        F.sum("points_redeemed").alias("total_points_redeemed"),
        F.max(activity_date()).alias("_last"),
        (_zero(_sum_when(F.col("year") == second_year)) - _zero(_sum_when(F.col("year") == first_year)))
        .alias("momentum_h2_minus_h1"),
        _zero(_sum_when(month.isin(10, 11, 12))).alias("q4_flights"),
    ]


def _record_rates(base: DataFrame) -> DataFrame:
    """Rates of the sums, measured from `_date`."""
    months = at_least(F.col("active_months"), 1)
    earned, burned = F.col("total_points_accumulated"), F.col("total_points_redeemed")
    mean = F.col("avg_flights_per_month")
    away = F.date_diff(F.col("_date"), F.col("_last")) / DAYS_PER_MONTH
    steadiness = 1 - clip(F.col("flight_std") / at_least(mean, 0.01), 0, 1)
    return (
        base.withColumns({
            "avg_flights_per_month": F.col("total_flights") / months,
            "avg_distance_per_month": F.col("total_distance") / months,
            "active_month_ratio": F.col("active_months") / at_least(F.col("months_recorded"), 1),
            "avg_points_per_month": earned / months,
            "redemption_rate": clip(burned / at_least(earned, 1.0), 0, 1),
            "points_balance": clip(earned - burned, 0),
            "recency_months": F.round(clip(away, 0), 1),
            "last_active_month": F.month("_last"),
        })
        .withColumn("flight_consistency", F.when(mean > 0, steadiness).otherwise(0.0))
        .drop("_last", "_date")
    )


def record_features(activity: DataFrame, years: tuple[int, int], date: str | None = None) -> DataFrame:
    """Totals over every row given (pass `until(...)` to keep later rows out). Without a date,
    recency counts from three months before the last record."""
    base = activity.groupBy(ID).agg(*_record_sums(years))
    if date is None:
        base = attach(base, prediction_date(activity).select(F.col("prediction_date").alias("_date")))
    else:
        base = base.withColumn("_date", F.lit(date).cast("date"))
    return _record_rates(base)


def record_matrix(
    members: DataFrame, activity: DataFrame, settings: Settings, date: str | None = None, rates: tuple[float, float] = (0.02, 0.90)
) -> DataFrame:
    """One row per member, seen or not: demographics, the features over all records (0 without records), the record
    window label `churn` and the weighted engagement score. Without a date the day is three months before the last record.

    One aggregate gives the features and the last record by the date. A label rate outside `rates` puts the fallback
    label in its place (last record over six months before the data end, or a cancellation).
    """
    ends = prediction_date(activity).first()
    day = date or str(ends["prediction_date"])
    base = activity.groupBy(ID).agg(
        *_record_sums((settings.feature_year, settings.label_year)),
        F.max(F.when(by_date(day), activity_date())).alias("last_activity_date"),
    ).withColumns({"_date": F.lit(day).cast("date"), "_recorded": F.col("_last")})
    history = _record_rates(base)
    joined = put_window_labels(members.join(history, ID, "left"), day)
    end = F.add_months(F.lit(str(ends["last_date"])).cast("date"), -6)
    fallback = F.greatest(flag(F.col("_recorded").isNull() | (F.col("_recorded") < end)), F.col("hard_churn"))
    measured = [c for c in history.columns if c not in (ID, "last_activity_date", "_recorded")]
    whole = cut_lineage(
        joined.withColumn("_fallback", fallback).drop("_recorded").fillna(0, subset=measured)
    )
    figures = attach(whole.agg(F.avg("churn").alias("rate")), member_statistics(whole)).first()
    usable = figures["rate"] is not None and rates[0] <= figures["rate"] <= rates[1]
    chosen = whole if usable else whole.withColumn("churn", F.col("_fallback"))
    encoded = encode_members(chosen.drop("_fallback"), replace(settings, prediction_date=day, ignore_case=True))
    return engagement_weighted(flag_high_clv(fill_salary(encoded, figures), figures))


def feature_means(features: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """`feature_group, feature, mean`, one aggregate for all groups."""
    listed = [(g, c) for g, columns in groups.items() for c in columns if c in features.columns]
    wide = features.agg(*[F.avg(c).alias(c) for c in dict.fromkeys(c for _, c in listed)])
    rows = [
        F.struct(F.lit(g).alias("feature_group"), F.lit(c).alias("feature"), F.col(c).alias("mean"))
        for g, c in listed
    ]
    return wide.select(F.inline(F.array(*rows)))
