"""Aggregate tables behind the charts, cards and the written report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import attach, lookup, money_sum, month_start
from tidemark.functions.ranks import quantile_row
from tidemark.functions.stats import as_rows

DIMENSIONS = ("loyalty_card", "gender", "education", "marital_status", "province", "enrollment_year")


def churn_by(labelled: DataFrame, dimension: str, label: str = "churned") -> DataFrame:
    return labelled.groupBy(dimension).agg(
        F.sum(label).alias("churned"), F.count(F.lit(1)).alias("members"),
        F.avg(label).alias("churn_rate"),
    )


def churn_by_all(labelled: DataFrame, dimensions: Sequence[str] = DIMENSIONS, label: str = "churned") -> DataFrame:
    """Every dimension's rollup in one pass: `dimension, level, churned, members, churn_rate`."""
    levels = labelled.select(
        F.col(label).alias("_label"),
        F.inline(F.array(*[
            F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("level")) for d in dimensions
        ])),
    )
    return levels.groupBy("dimension", "level").agg(
        F.sum("_label").alias("churned"), F.count(F.lit(1)).alias("members"),
        F.avg("_label").alias("churn_rate"),
    )


def crosstab(labelled: DataFrame, by: str, label: str = "churned") -> DataFrame:
    """Members per level, retained and churned side by side; empty cells are 0."""
    wide = labelled.groupBy(by).pivot(label, [0, 1]).count()
    return wide.toDF(by, "retained", "churned").fillna(0)


def segment_summary(scored: DataFrame, by: str = "segment_name") -> DataFrame:
    return scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("members"), F.avg("churned").alias("churn_rate"),
        F.avg("clv").alias("avg_clv"), F.avg("engagement_health_score").alias("avg_engagement"),
        money_sum("revenue_at_risk").alias("revenue_at_risk"),
    )


def cohort_stats(scored: DataFrame) -> DataFrame:
    return scored.groupBy("enrollment_year").agg(
        F.count(F.lit(1)).alias("members"), F.avg("churned").alias("churn_rate"),
        F.avg("clv").alias("avg_clv"), F.avg("engagement_health_score").alias("avg_engagement"),
    )


def min_support(groups: DataFrame, rows: int = 50) -> DataFrame:
    return groups.where(F.col("members") >= rows)


def rate_band(rate: Column, red: float, amber: float) -> Column:
    return F.when(rate > red, "red").when(rate > amber, "amber").otherwise("green")


def normalised_means(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Group means scaled over the groups: (x - min) / (max - min + 1e-6)."""
    means = df.groupBy(by).agg(*[F.avg(c).alias(c) for c in columns])
    spans = means.agg(
        *[F.min(c).alias(f"{c}__min") for c in columns], *[F.max(c).alias(f"{c}__max") for c in columns]
    )
    return attach(means, spans).select(
        by,
        *[
            ((F.col(c) - F.col(f"{c}__min")) / (F.col(f"{c}__max") - F.col(f"{c}__min") + 1e-6)).alias(c)
            for c in columns
        ],
    )


def portfolio_kpis(scored: DataFrame) -> DataFrame:
    high, medium = F.col("risk_level") == "High", F.col("risk_level") == "Medium"
    at_risk = high | medium
    return scored.agg(
        F.count(F.lit(1)).alias("members"),
        F.avg("churned").alias("churn_rate_combined"),
        F.avg("hard_churn").alias("churn_rate_hard"),
        F.avg("activity_churn").alias("churn_rate_activity"),
        F.count_if(high).alias("at_risk_high"),
        F.count_if(medium).alias("at_risk_medium"),
        money_sum("revenue_at_risk").alias("total_revenue_at_risk"),
        money_sum("potential_save").alias("total_potential_save"),
        money_sum(F.when(at_risk, F.col("revenue_at_risk"))).alias("at_risk_revenue"),
        money_sum(F.when(at_risk, F.col("potential_save"))).alias("at_risk_save"),
        F.count_distinct("segment_name").alias("num_segments"),
    )


DRILLDOWN = (
    "churned", "clv", "avg_flights_per_month", "recency_months", "active_month_ratio",
    "redemption_rate", "engagement_health_score", "tenure_months",
)


def segment_drilldown(scored: DataFrame, segment: str) -> DataFrame:
    chosen = scored.where(F.col("segment_name") == segment)
    return chosen.agg(F.count(F.lit(1)).alias("members"), *[F.avg(c).alias(f"avg_{c}") for c in DRILLDOWN])


def monthly_totals(activity: DataFrame) -> DataFrame:
    return activity.groupBy("year", "month").agg(F.sum("total_flights").alias("total_flights")).select(
        month_start(F.col("year"), F.col("month")).alias("activity_date"), "total_flights"
    )


def peak_months(activity: DataFrame) -> DataFrame:
    """Busiest and quietest month, the earliest on a tie."""
    monthly = monthly_totals(activity)
    day = F.col("activity_date")
    busiest = F.min(F.struct((-F.col("total_flights")).alias("x"), day.alias("d")))
    quietest = F.min(F.struct(F.col("total_flights").alias("x"), day.alias("d")))
    ends = monthly.agg(busiest.alias("b"), quietest.alias("q"))
    return ends.select(
        F.date_format("b.d", "yyyy-MM").alias("busiest"), (-F.col("b.x")).alias("busiest_flights"),
        F.date_format("q.d", "yyyy-MM").alias("quietest"), F.col("q.x").alias("quietest_flights"),
    )


def seasonality(activity: DataFrame) -> DataFrame:
    """Mean flights of a member-month, per calendar month."""
    return activity.groupBy("month").agg(F.avg("total_flights").alias("avg_flights"))


def member_totals(activity: DataFrame) -> DataFrame:
    """Distribution of total flights per member in one row."""
    totals = activity.groupBy("loyalty_number").agg(F.sum("total_flights").alias("flights"))
    summary = totals.agg(F.avg("flights").alias("avg_flights"), F.max("flights").alias("max_flights"))
    return attach(summary, quantile_row(totals, {"median_flights": ("flights", 0.5)}))


def activity_profile(activity: DataFrame, date: Column) -> DataFrame:
    """Exploration view of a member's activity: totals, distinct months and unrounded recency."""
    at = month_start(F.col("year"), F.col("month"))
    base = activity.groupBy("loyalty_number").agg(
        F.sum("total_flights").alias("total_flights"), F.sum("distance").alias("total_distance"),
        F.count_distinct(at).alias("active_months"), F.min(at).alias("first_date"),
        F.max(at).alias("last_date"),
    )
    months = F.greatest(F.date_diff(date, F.col("last_date")) / 30.44, F.lit(0.0))
    return base.withColumns({
        "avg_flights_mo": F.col("total_flights") / F.greatest("active_months", F.lit(1)),
        "recency_months": months,
    })


def metric_table(scored: DataFrame, activity: DataFrame) -> DataFrame:
    """`metric, value` summary as numbers."""
    months = activity.groupBy("loyalty_number").agg(
        F.sum("total_flights").alias("flights"), F.count(F.lit(1)).alias("months"),
        F.sum("points_accumulated").alias("earned"), F.sum("points_redeemed").alias("burned"),
    )
    rate = F.least(F.col("burned") / F.greatest("earned", F.lit(1.0)), F.lit(1.0))
    use = months.agg(
        F.avg(F.col("flights") / F.greatest("months", F.lit(1))).alias("pace"),
        F.avg(rate).alias("redemption"), F.sum("months").alias("records"),
    )
    base = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("churned").alias("churned"))
    wide = attach(attach(base, use), quantile_row(scored, {"median_clv": ("clv", 0.5)}))
    values = {
        "Total Customers": F.col("n"), "Churned": F.col("churned"),
        "Retained": F.col("n") - F.col("churned"), "Churn Rate": F.col("churned") / F.col("n"),
        "Median CLV": F.col("median_clv"), "Avg Flights/Month": F.col("pace"),
        "Avg Redemption Rate": F.col("redemption"), "Total Activity Records": F.col("records"),
    }
    return as_rows(wide, {k: (v.cast("double"),) for k, v in values.items()}, ["metric", "value"])


def recommendation_summary(recommended: DataFrame, by: str) -> DataFrame:
    return recommended.groupBy(by).agg(
        F.count("churn_probability").alias("members"), F.avg("churn_probability").alias("avg_probability"),
        money_sum("revenue_at_risk").alias("revenue_at_risk"), money_sum("potential_save").alias("potential_save"),
    )


def portfolio_summary(recommended: DataFrame) -> DataFrame:
    """Totals of a recommendation table in one row."""
    high, medium = F.col("risk_level") == "High Risk", F.col("risk_level") == "Medium Risk"
    return recommended.agg(
        F.count(F.lit(1)).alias("members"), F.count_if(high | medium).alias("at_risk"),
        F.count_if(high).alias("high_risk"),
        money_sum("revenue_at_risk").alias("revenue_at_risk"), money_sum("potential_save").alias("potential_save"),
    ).withColumn("at_risk_share", F.col("at_risk") / F.col("members"))


def extremes(groups: DataFrame, name: str, measure: str) -> DataFrame:
    """First and last group by a measure (names in order on a tie), without a sort."""
    top = F.min(F.struct((-F.col(measure)).alias("x"), F.col(name).alias("n")))
    low = F.min(F.struct(F.col(measure).alias("x"), F.col(name).alias("n")))
    return groups.agg(top.alias("t"), low.alias("l")).select(
        F.col("t.n").alias(f"highest_{name}"), (-F.col("t.x")).alias(f"highest_{name}_{measure}"),
        F.col("l.n").alias(f"lowest_{name}"), F.col("l.x").alias(f"lowest_{name}_{measure}"),
    )


def report_facts(scored: DataFrame) -> DataFrame:
    """The figures of the written report, in one row."""
    segments = extremes(segment_summary(scored), "segment_name", "churn_rate")
    provinces = extremes(segment_summary(scored, "province"), "province", "churn_rate")
    year, rate = F.col("enrollment_year"), F.col("churn_rate")
    cohorts = cohort_stats(scored).where(year.isNotNull()).agg(
        F.max(year).alias("newest_cohort"), F.max_by(rate, year).alias("newest_churn_rate"),
        F.min(year).alias("oldest_cohort"), F.min_by(rate, year).alias("oldest_churn_rate"),
    )
    overall = scored.agg(
        F.avg("churned").alias("churn_rate"),
        (money_sum("potential_save") * 0.45).alias("high_risk_recovery"),
    )
    wide = attach(attach(attach(overall, segments), provinces), cohorts)
    return wide.withColumn("cohort_multiple", F.col("newest_churn_rate") / F.col("churn_rate"))


def segment_revenue(scored: DataFrame) -> DataFrame:
    """Count, share, churn, CLV and revenue (count x mean) per segment."""
    groups = scored.groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("members"), F.avg("churned").alias("churn_rate"),
        F.avg("clv").alias("avg_clv"), F.avg("revenue_at_risk").alias("avg_revenue_at_risk"),
    )
    total = groups.agg(F.sum("members").alias("_total"))
    return attach(groups, total).withColumns({
        "share": F.col("members") / F.col("_total"),
        "revenue_at_risk": F.col("members") * F.col("avg_revenue_at_risk"),
    }).drop("_total")


def risk_value_quadrants(groups: DataFrame, name: str = "segment_name") -> DataFrame:
    """Each segment against the medians of the segments' CLV and churn."""
    middle = groups.agg(F.median("avg_clv").alias("_clv"), F.median("churn_rate").alias("_churn"))
    worth = F.when(F.col("avg_clv") >= F.col("_clv"), "high value").otherwise("low value")
    risk = F.when(F.col("churn_rate") >= F.col("_churn"), "high risk").otherwise("low risk")
    return attach(groups, middle).select(
        name, "avg_clv", "churn_rate", F.col("_clv").alias("median_clv"), F.col("_churn").alias("median_churn"),
        F.concat_ws(", ", worth, risk).alias("quadrant"),
    )


def category_order(groups: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Only the listed categories, in the listed order."""
    position = lookup(F.col(column), {c: i for i, c in enumerate(order)}, -1)
    return groups.withColumn("position", position).where(F.col("position") >= 0).orderBy("position")


def filter_choices(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per filter column: `filter, choice`, from one pass."""
    entries = [F.struct(F.lit(c).alias("filter"), F.col(c).cast("string").alias("choice")) for c in columns]
    listed = df.select(F.inline(F.array(*entries))).where(F.col("choice").isNotNull())
    return listed.distinct().orderBy("filter", "choice")


def hashed_sample(df: DataFrame, rows: int, seed: int = 42, id_column: str = "loyalty_number") -> DataFrame:
    """A repeatable sample of `rows` rows: the smallest digests of id and seed."""
    return df.orderBy(F.md5(F.concat_ws("/", F.col(id_column), F.lit(seed))), id_column).limit(rows)


def summary_document(scored: DataFrame, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One nested row: totals, per-segment map, province array and cohort map. The lists hold a
    row per dimension level."""
    kpis = portfolio_kpis(scored)
    by_segment = segment_revenue(scored).agg(
        F.map_from_entries(F.collect_list(F.struct(
            "segment_name", F.struct("members", "churn_rate", "avg_clv", "avg_revenue_at_risk"),
        ))).alias("segment_profiles")
    )
    by_province = segment_summary(scored, "province").agg(
        F.sort_array(F.collect_list(F.struct(
            "churn_rate", "province", "members", "avg_clv", "revenue_at_risk",
        )), asc=False).alias("geographic")
    )
    by_cohort = cohort_stats(scored).where(F.col("enrollment_year").isNotNull()).agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.col("enrollment_year").cast("string"), F.struct("members", "churn_rate", "avg_clv"),
        ))).alias("cohorts")
    )
    out = attach(attach(attach(kpis, by_segment), by_province), by_cohort)
    return out.withColumns(dict(extra)) if extra else out


def document_rows(document: DataFrame) -> DataFrame:
    """The summary document as `section, name, measure, value` rows, a row per number."""
    totals = [c for c, kind in document.dtypes if kind in ("bigint", "int", "double")]

    def measures(entry: Column, kind: T.StructType) -> Column:
        return F.array(*[
            F.struct(F.lit(f.name).alias("measure"), entry[f.name].cast("double").alias("value"))
            for f in kind.fields if isinstance(f.dataType, T.NumericType)
        ])

    def entries(column: str) -> DataFrame:
        kind = document.schema[column].dataType
        if isinstance(kind, T.MapType):
            found = document.select(F.explode(column).alias("name", "entry"))
            inner = kind.valueType
        else:
            inner = kind.elementType
            label = next(f.name for f in inner.fields if isinstance(f.dataType, T.StringType))
            found = document.select(F.explode(column).alias("entry")).withColumn("name", F.col(f"entry.{label}"))
        rows = found.select("name", F.explode(measures(F.col("entry"), inner)).alias("m"))
        return rows.select(F.lit(column).alias("section"), "name", "m.measure", "m.value")

    whole = document.select(F.explode(measures(F.struct(*totals), T.StructType([document.schema[c] for c in totals]))).alias("m"))
    out = whole.select(F.lit("totals").alias("section"), F.lit("all").alias("name"), "m.measure", "m.value")
    for column in ("segment_profiles", "geographic", "cohorts"):
        out = out.unionByName(entries(column))
    return out
