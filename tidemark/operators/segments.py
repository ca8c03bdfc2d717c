"""Segmentation: clustering, profiles and names."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import attach
from tidemark.functions.ranks import percent_rank_mean
from tidemark.functions.stats import minmax, moments, ranges, standardised
from tidemark.operators import offers as dims
from tidemark.session import cut_lineage

# The columns that each of the three published variants clusters by.
PROGRAMME_FEATURES = [
    "avg_flights_per_month", "recency_months", "active_month_ratio", "redemption_rate", "clv_log",
    "tier_numeric", "tenure_months", "engagement_health_score", "momentum_h2_minus_h1",
    "total_distance", "dollar_cost_per_flight", "q4_flights",
]
STAGED_FEATURES = [
    "recency_days", "avg_flights_per_month", "clv_log", "clv_percentile", "consistency_score",
    "engagement_slope", "redemption_rate", "active_month_ratio", "loyalty_health_score",
    "zero_flight_month_pct", "flight_trend_3m_vs_6m", "seasonality_score", "earn_burn_ratio",
    "total_flights_historical", "activity_trajectory",
]
MODULE_FEATURES = [
    "recency_days", "total_flights", "avg_flights_mo", "clv", "engagement_score",
    "consistency_score", "momentum_ratio", "redemption_rate", "yoy_growth", "seasonality_score",
]

# Segment names by value rank, for active and for quiet clusters.
ACTIVE_NAMES = ["Active Champions", "Miles Hoarders", "Engaged Regulars", "Budget Fliers"]
QUIET_NAMES = ["Premium Dormant", "Seasonal Travelers", "Inactive Low-Value"]
ACTIVE_FLIGHTS = 0.5


# --- clustering ---------------------------------------------------------------------------------


def point(df: DataFrame, features: Sequence[str], standard: bool = False) -> tuple[Column, Row]:
    """The min-max (or standard) scaled features as one array, absent ones as 0, and the figures they are scaled by."""
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    figures = (moments if standard else ranges)(filled, features).first()

    def scaled(c: str) -> Column:
        low, high = (F.lit(figures[f"{c}__{n}"]).cast("double") for n in (("mean", "std") if standard else ("min", "max")))
        return (standardised if standard else minmax)(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), low, high)

    return F.array(*[scaled(c) for c in features]), figures


def assemble(df: DataFrame, features: Sequence[str], vector: Column | None = None) -> DataFrame:
    """`vector`, an array of the features, for the iterative fits; cut from the plan that made it."""
    array = F.array(*[F.col(c).cast("double") for c in features]) if vector is None else vector
    return cut_lineage(df.select(array.alias("vector")))


def nearest_centroid(df: DataFrame, features: Sequence[str], centroids: DataFrame) -> DataFrame:
    """Add `segment_id` of the closest centroid (`segment_id`, features: a row per cluster). The
    centroids travel as one array, so rows are not multiplied; ties go to the smaller id."""
    point = F.array(*[F.col(c).cast("double") for c in features])
    packed = centroids.agg(
        F.collect_list(F.struct("segment_id", point.alias("centre"))).alias("_centres")
    )

    def distance(centre: Column) -> Column:
        squares = F.zip_with(F.col("_point"), centre, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)

    nearest = F.array_min(
        F.transform("_centres", lambda c: F.struct(
            distance(c["centre"]).alias("distance"), c["segment_id"].alias("segment_id")))
    )
    kept = [c for c in df.columns if c != "segment_id"]
    return (
        attach(df.select(*kept, point.alias("_point")), packed)
        .withColumn("_nearest", nearest)
        .select(*kept, F.col("_nearest.segment_id").alias("segment_id"))
    )


def principal_components(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> tuple[DataFrame, list[float]]:
    """First two components of the features, and the shares of variance they explain.

    Means and covariances are one aggregate; the d x d matrix alone is decomposed on the driver. A component's largest
    loading is positive, so its sign does not depend on the library.
    """
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    sums = df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in features], *[F.covar_pop(a, b).alias(f"{a}__{b}") for a, b in pairs]
    ).first()
    order = {c: i for i, c in enumerate(features)}
    matrix = np.zeros((len(features), len(features)))
    for a, b in pairs:
        matrix[order[a], order[b]] = matrix[order[b], order[a]] = sums[f"{a}__{b}"] or 0.0
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    total = float(values.sum()) or 1.0

    def projected(i: int) -> Column:
        loads = vectors[:, i] * np.sign(vectors[np.abs(vectors[:, i]).argmax(), i])
        terms = [(F.col(c) - F.lit(sums[f"{c}__mean"])) * F.lit(float(w)) for c, w in zip(features, loads)]
        return sum(terms, F.lit(0.0))

    shares = [float(v) / total for v in values[:2]]
    return df.select(*keep, projected(0).alias("pc1"), projected(1).alias("pc2")), shares


# --- profiles -----------------------------------------------------------------------------------


def programme_profiles(features: DataFrame) -> DataFrame:
    """Cluster means rounded to three places; the rounded values decide the names."""
    means = {
        "avg_flights": "avg_flights_per_month", "recency": "recency_months",
        "active_ratio": "active_month_ratio", "churn_rate": "churned", "avg_clv": "clv",
        "avg_dist": "total_distance",
    }
    return features.groupBy("segment_id").agg(
        *[F.round(F.avg(c), 3).alias(name) for name, c in means.items()],
        F.count(F.lit(1)).alias("members"),
    )


def segment_profiles(features: DataFrame, columns: Sequence[str], label: str | None = None) -> DataFrame:
    """Size, share and `avg_<column>` per cluster, with churn when a label is given."""
    measures = [F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"avg_{c}") for c in columns]]
    if label is not None:
        measures += [
            (F.avg(label) * 100).alias("churn_rate_pct"), F.sum(label).alias("churned_count"),
        ]
    profiles = features.groupBy("segment_id").agg(*measures)
    total = profiles.agg(F.sum("size").alias("_total"))
    shared = attach(profiles, total).withColumn("size_pct", F.col("size") * 100.0 / F.col("_total"))
    return shared.drop("_total")


# --- names --------------------------------------------------------------------------------------


def names_by_rank(profiles: DataFrame) -> DataFrame:
    """Split clusters on activity, rank each side by CLV, and read the name off the rank; ranks
    past the end of a list take its last name. A profile has one row per cluster."""
    active = F.col("avg_flights") >= ACTIVE_FLIGHTS
    rank = F.row_number().over(Window.partitionBy("is_active").orderBy(F.desc("avg_clv"), "segment_id"))

    def pick(names: Sequence[str]) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in names]), F.least(F.col("clv_rank"), F.lit(len(names))))

    return (
        profiles.withColumn("is_active", active.cast("int"))
        .withColumn("clv_rank", rank)
        .withColumn("segment_name", F.when(active, pick(ACTIVE_NAMES)).otherwise(pick(QUIET_NAMES)))
    )


def _rank_or_half(profiles: DataFrame, name: str) -> Column:
    return percent_rank_mean(name) if name in profiles.columns else F.lit(0.5)


def staged_rules(profiles: DataFrame) -> DataFrame:
    """Relative ranks of the cluster profiles and the names the rule chain allows, best first."""
    sources = {
        "clv": "avg_clv_percentile", "churn": "churn_rate_pct", "recency": "avg_recency_days",
        "engagement": "avg_active_month_ratio", "redemption": "avg_redemption_rate",
        "frequency": "avg_avg_flights_per_month", "trend": "avg_flight_trend_3m_vs_6m",
        "health": "avg_loyalty_health_score",
    }
    ranked = profiles.withColumns(
        {f"{name}_rank": _rank_or_half(profiles, c) for name, c in sources.items()}
    )
    r = {name: F.col(f"{name}_rank") for name in sources}

    def names(*options: str) -> Column:
        return F.array(*[F.lit(o) for o in options])

    chain = (
        F.when((r["clv"] >= 0.6) & (r["churn"] >= 0.65), names("At-Risk VIPs"))
        .when((r["clv"] >= 0.6) & (r["health"] >= 0.6) & (r["churn"] < 0.35), names("Premium Loyalists"))
        .when((r["recency"] >= 0.65) & (r["engagement"] < 0.4), names("Silent Drifters"))
        .when((r["redemption"] < 0.35) & ~(r["clv"] < 0.4), names("Miles Hoarders"))
        .when((r["trend"] >= 0.55) & (r["churn"] < 0.35), names("Rising Stars"))
        .when((r["frequency"] >= 0.6) & (r["clv"] < 0.4), names("Budget Frequent Flyers"))
        .otherwise(names("Seasonal Travelers", "Premium Loyalists", "Rising Stars", "Miles Hoarders"))
    )
    return ranked.withColumn("candidates", chain)


def module_rules(profiles: DataFrame) -> DataFrame:
    """Ranks for value and engagement, absolute thresholds for the rest."""
    defaults = {"recency_days": 180.0, "momentum_ratio": 1.0, "redemption_rate": 0.5, "seasonality_score": 0.0}
    at = {c: F.col(c) if c in profiles.columns else F.lit(v) for c, v in defaults.items()}
    ranked = profiles.withColumns({
        "clv_rank": _rank_or_half(profiles, "clv"),
        "engagement_rank": _rank_or_half(profiles, "engagement_score"),
    })
    value, engaged = F.col("clv_rank"), F.col("engagement_rank")
    chain = (
        F.when((value > 0.75) & (engaged > 0.6), "Premium Loyalists")
        .when((value > 0.75) & (engaged < 0.4), "At-Risk VIPs")
        .when((engaged < 0.3) & (at["recency_days"] > 200), "Silent Drifters")
        .when((at["redemption_rate"] < 0.2) & (value > 0.4), "Miles Hoarders")
        .when(at["momentum_ratio"] > 1.3, "Rising Stars")
        .when(at["seasonality_score"] > 0.5, "Seasonal Travelers")
        .otherwise("Budget Frequent Flyers")
    )
    return ranked.withColumn("candidates", F.array(chain))


def unique_names(ruled: DataFrame, spare: Sequence[str] = (), prefix: str = "Segment Group") -> DataFrame:
    """`segment_id, segment_name` with no name used twice, in order of segment id.

    The table has a row per cluster (k is a handful), so the greedy choice is a fold over one small array.
    When every candidate is taken the first free spare name follows, then a numbered one.
    """
    rows = ruled.agg(
        F.sort_array(F.collect_list(F.struct(F.col("segment_id").cast("int").alias("segment_id"), "candidates"))).alias("rows")
    )
    spares = F.array(*[F.lit(n) for n in spare]).cast("array<string>")

    def choose(taken: Column, row: Column) -> Column:
        used = F.transform(taken, lambda t: t["segment_name"])
        numbered = F.transform(F.sequence(F.lit(1), F.size(taken) + 1), lambda i: F.concat_ws(" ", F.lit(prefix), i))
        free = F.filter(F.concat(row["candidates"], spares, numbered), lambda o: ~F.array_contains(used, o))
        return F.concat(taken, F.array(F.struct(row["segment_id"].alias("segment_id"), free[0].alias("segment_name"))))

    start = F.array().cast("array<struct<segment_id:int,segment_name:string>>")
    return rows.select(F.inline(F.aggregate("rows", start, choose)))


def attach_archetypes(named: DataFrame, staged: bool = False) -> DataFrame:
    """Strategy, offer, urgency and channel of the name, with defaults for other names; `staged` takes the
    staged scripts' table."""
    joined = named.join(F.broadcast(dims.archetypes(named.sparkSession, staged)), "segment_name", "left")
    return joined.withColumns(
        {c: F.coalesce(c, F.lit(v)) for c, v in dims.DEFAULT_ARCHETYPE.items()}
    )


def put_names(features: DataFrame, names: DataFrame) -> DataFrame:
    """Names of a handful of clusters onto all members."""
    return features.join(F.broadcast(names.select("segment_id", "segment_name")), "segment_id", "left")
