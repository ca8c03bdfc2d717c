"""Registered queries: each builds a DataFrame over the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import exprs, ranks, stats
from tidemark.operators import cleaning, evaluation, features, labels, models, offers, reports, retention
from tidemark.operators import segments
from tidemark.plans.bed import Bed, tidy
from tidemark.sources import columns, schemas

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ID = "loyalty_number"


def query(build: Callable[[Bed], DataFrame]) -> Callable[[Bed], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Bed(spark, folder))
    return build


# --- projection, filters, helpers -------------------------------------------------------------------


@query
def projection_renames(b: Bed) -> DataFrame:
    spaced = b.members.select(
        F.col(ID).alias("Loyalty Number"), F.col("province").alias(" Province "),
        F.col("loyalty_card").alias("Loyalty Card"), F.col("clv").alias("CLV"), "gender",
    )
    named = columns.normalise_headers(spaced).drop("gender", "no_such_column")
    renamed = named.withColumnRenamed("loyalty_card", "tier")
    return tidy(renamed.withColumn("clv_thousands", F.col("clv") / 1000))


@query
def column_helpers(b: Bed) -> DataFrame:
    found = columns.find_column(b.members.columns, "cancel", "year")
    numbers = columns.feature_columns(b.members, {ID, "enrollment_month", found, "cancellation_month"})
    topped = columns.preferred_columns(b.members, ["clv", "not_here"], {ID}, minimum=2)
    aligned = columns.align_columns(
        b.members.withColumn("cancelled_in", F.col(found)), [*numbers, "recency"], [ID, "cancelled_in"]
    )
    with_flag = columns.with_default(aligned, "has_clv", lambda: exprs.flag(F.col(topped[0]) > 0))
    return tidy(columns.with_default(with_flag, "salary", lambda: F.lit(0.0)))


@query
def activity_filters(b: Bed) -> DataFrame:
    year = b.settings.feature_year
    rows = b.activity.where(
        (F.col("year") == year) & (F.col("month").between(4, 9)) & F.col("month").isin(6, 7, 8)
    )
    live = b.members.where(F.col("cancellation_year").isNull() & F.col("salary").isNotNull())
    high, own = F.col("total_flights") > 1, F.col("points_redeemed") > 0
    return tidy(
        rows.join(live.select(ID), ID, "left_semi").select(
            ID, "month", "total_flights",
            exprs.flag(high | own).alias("either"), exprs.flag(high & own).alias("both"),
            exprs.flag(~high).alias("neither_high"),
        )
    )


@query
def cutoff_filter(b: Bed) -> DataFrame:
    return tidy(features.until(b.activity, b.settings.prediction_date), ID, "year", "month", "total_flights")


@query
def trailing_windows(b: Bed) -> DataFrame:
    out = features.trailing_features(b.activity, b.settings.prediction_date)
    return tidy(out, ID, "flights_3m", "flights_6m", "flights_ly", "flights_py")


@query
def null_to_zero(b: Bed) -> DataFrame:
    agg = features.in_year(b.activity, b.settings.feature_year).groupBy(ID).agg(
        F.sum("total_flights").alias("flights"), F.sum("distance").alias("miles")
    )
    joined = b.members.select(ID, "salary").join(agg, ID, "left")
    return tidy(joined.fillna(0, subset=["flights", "miles"]))


# --- joins ------------------------------------------------------------------------------------------


@query
def member_activity_join(b: Bed) -> DataFrame:
    agg = b.activity.groupBy(ID).agg(
        F.sum("total_flights").alias("flights"), F.max("year").alias("last_year")
    )
    return tidy(b.members.select(ID, "loyalty_card").join(agg, ID, "left"))


@query
def calendar_join(b: Bed) -> DataFrame:
    rows = features.in_year(b.activity, b.settings.feature_year)
    joined = rows.join(cleaning.quarter_map(b.calendar), ["year", "month"], "left")
    return tidy(joined, ID, "year", "month", "quarter", "total_flights")


@query
def suffix_join(b: Bed) -> DataFrame:
    left = b.labels.select(ID, "churned", F.when(F.col(ID) % 5 != 0, F.col("province")).alias("province"))
    right = b.members.select(ID, F.col("province").alias("province_raw")).distinct()
    joined = left.join(right, ID, "left")
    return tidy(joined.withColumn("place", F.coalesce("province", "province_raw")))


@query
def dict_lookup(b: Bed) -> DataFrame:
    s = b.settings
    flown = features.in_year(b.activity, s.label_year).groupBy(ID).agg(F.sum("total_flights").alias("flights"))
    return tidy(b.members.join(flown, ID, "left").select(
        ID, exprs.lookup(F.col("loyalty_card"), s.tier_levels, 1).alias("tier_numeric"),
        exprs.lookup(F.col("education"), s.education_levels, 2).alias("education_numeric"),
        exprs.lookup(F.col("province"), s.province_codes, 0).alias("province_code"),
        F.coalesce("flights", F.lit(0)).alias("flights"),
    ))


@query
def two_level_lookup(b: Bed) -> DataFrame:
    return tidy(
        retention.programme_actions(b.scored), ID, "segment_name", "risk_level", "action", "offer",
        "channel", "timing", "incentive_cost",
    )


@query
def lift_lookup(b: Bed) -> DataFrame:
    return tidy(retention.staged_recommendations(b.staged), ID, "seg_name", "risk_key", "lift")


@query
def key_union(b: Bed) -> DataFrame:
    year = b.settings.label_year
    ids = features.in_year(b.activity, year).select(ID).unionByName(
        features.in_year(b.activity, year - 1).select(ID)
    ).distinct()
    flown = features.in_year(b.activity, year).groupBy(ID).agg(F.sum("total_flights").alias("flights"))
    return tidy(ids.join(flown, ID, "left").fillna(0, subset=["flights"]))


@query
def scalar_broadcast(b: Bed) -> DataFrame:
    one = b.members.agg(F.max("clv").alias("top"), F.avg("clv").alias("mean"), F.min("clv").alias("low"))
    return tidy(exprs.attach(b.members.select(ID, "clv"), one).select(
        ID, (F.col("clv") / F.col("top")).alias("share_of_top"),
        (F.col("clv") - F.col("mean")).alias("above_mean"), (F.col("clv") - F.col("low")).alias("above_low"),
    ))


# --- aggregates -------------------------------------------------------------------------------------


@query
def activity_aggregates(b: Bed) -> DataFrame:
    flights, month = F.col("total_flights"), F.col("month")
    at = labels.activity_date()
    return tidy(b.activity.groupBy(ID).agg(
        F.sum("total_flights").alias("flights"), F.avg("distance").alias("avg_distance"),
        F.max("points_accumulated").alias("max_points"), F.count("total_flights").alias("records"),
        F.coalesce(F.stddev_samp("distance"), F.lit(0.0)).alias("distance_std"),
        F.count_if(flights > 1).alias("busy_months"),
        F.coalesce(F.max(F.when(flights > 1, month)), F.lit(0)).alias("last_busy_month"),
        F.count_distinct("year").alias("years"), F.min(at).alias("first_date"), F.max(at).alias("last_date"),
    ))


@query
def global_quantiles(b: Bed) -> DataFrame:
    table = ranks.quantile_table(b.members, ["salary", "clv"], [0.01, 0.25, 0.5, 0.75, 0.99])
    return tidy(table, "column", "prob", "n", "value")


@query
def median_clv_by_group(b: Bed) -> DataFrame:
    table = ranks.quantile_table(b.labels, ["clv"], [0.5], ["loyalty_card", "churned"])
    return tidy(table.withColumnRenamed("value", "median_clv"), "loyalty_card", "churned", "n", "median_clv")


@query
def flag_rates(b: Bed) -> DataFrame:
    return tidy(b.labels.agg(*[
        F.avg(c).alias(f"{c}_rate") for c in ("hard_churn", "activity_churn", "churned")
    ]))


@query
def frequency_table(b: Bed) -> DataFrame:
    return tidy(b.members.groupBy("education").agg(F.count(F.lit(1)).alias("members")))


@query
def frequency_share(b: Bed) -> DataFrame:
    return tidy(stats.shares(b.scored, "risk_level"))


@query
def tier_churn_crosstab(b: Bed) -> DataFrame:
    return tidy(reports.crosstab(b.labels, "loyalty_card"))


@query
def churn_by_tier(b: Bed) -> DataFrame:
    return tidy(reports.churn_by(b.labels, "loyalty_card"))


@query
def churn_by_dimension_sets(b: Bed) -> DataFrame:
    return tidy(reports.churn_by_all(b.labels))


@query
def monthly_totals(b: Bed) -> DataFrame:
    return tidy(reports.monthly_totals(b.activity))


@query
def peak_months(b: Bed) -> DataFrame:
    return tidy(reports.peak_months(b.activity))


@query
def seasonality(b: Bed) -> DataFrame:
    return tidy(reports.seasonality(b.activity))


@query
def activity_distribution(b: Bed) -> DataFrame:
    return tidy(reports.member_totals(b.activity))


@query
def numeric_summary(b: Bed) -> DataFrame:
    return tidy(stats.describe(b.members, ["salary", "clv", "enrollment_year", "cancellation_month"]))


@query
def null_profile(b: Bed) -> DataFrame:
    return tidy(stats.null_profile(b.members))


@query
def clv_histogram(b: Bed) -> DataFrame:
    return tidy(stats.histogram(b.labels, "clv", 40, ["churned"]))


@query
def winsorised_clv(b: Bed) -> DataFrame:
    return tidy(stats.winsorise(b.members, "clv"), ID, "clv")


@query
def boxplot_stats(b: Bed) -> DataFrame:
    return tidy(stats.box_plot(b.members, "clv", "loyalty_card"))


@query
def churn_correlations(b: Bed) -> DataFrame:
    chosen = [
        "clv", "tenure_months", "total_flights", "active_month_ratio", "redemption_rate",
        "q4_flights", "recency_months", "engagement_health_score", "points_balance",
    ]
    return tidy(stats.correlation_with(b.features, chosen, "churned"))


@query
def correlation_matrix(b: Bed) -> DataFrame:
    chosen = ["clv", "total_flights", "redemption_rate", "recency_months", "churned"]
    return tidy(stats.correlation_matrix(b.features, chosen))


# --- cleaning and quality ---------------------------------------------------------------------------


@query
def keep_first(b: Bed) -> DataFrame:
    return tidy(
        cleaning.keep_first(b.activity_raw, [ID, "year", "month"], "record_id"),
        ID, "year", "month", "record_id", "distance", "points_accumulated",
    )


@query
def clean_members(b: Bed) -> DataFrame:
    holed = b.members.withColumn("province", F.when(F.col(ID) % 9 != 0, F.col("province")))
    return tidy(cleaning.clean_members(holed))


@query
def salary_fill(b: Bed) -> DataFrame:
    return tidy(cleaning.fill_salary(b.members), ID, "salary", "salary_missing")


@query
def clean_activity(b: Bed) -> DataFrame:
    holed = b.activity_raw.withColumns({
        "distance": F.when(F.col("record_id") % 7 != 0, F.col("distance") - 50),
        "points_redeemed": F.when(F.col("record_id") % 11 != 0, F.col("points_redeemed")),
    })
    cleaned = cleaning.clean_activity(holed, schemas.ACTIVITY_MEASURES, "record_id")
    return tidy(cleaned, ID, "activity_date", "record_id", "total_flights", "distance", "points_redeemed")


@query
def calendar_quarters(b: Bed) -> DataFrame:
    return tidy(cleaning.quarter_map(b.calendar))


@query
def calendar_distinct(b: Bed) -> DataFrame:
    return tidy(b.calendar.select(F.year("date").alias("year"), F.month("date").alias("month")).distinct())


@query
def age_clamp(b: Bed) -> DataFrame:
    aged = b.members.select(ID, (F.col(ID) % 120).cast("int").alias("member_age"))
    return tidy(cleaning.clamp_age(aged))


@query
def median_impute(b: Bed) -> DataFrame:
    return tidy(stats.median_fill(b.members.select(ID, "salary", "cancellation_month"), ["salary", "cancellation_month"]))


@query
def duplicate_audit(b: Bed) -> DataFrame:
    return tidy(cleaning.duplicate_audit({
        "loyalty": (b.members, [ID]), "activity": (b.activity_raw, [ID, "year", "month"]),
        "activity rows": (b.activity, b.activity.columns),
    }))


@query
def cleaning_log(b: Bed) -> DataFrame:
    holed = b.members.withColumn("province", F.when(F.col(ID) % 9 != 0, F.col("province")))
    return tidy(cleaning.cleaning_log(holed, b.activity_raw))


@query
def quality_issues(b: Bed) -> DataFrame:
    return tidy(cleaning.quality_issues(b.members, b.activity_raw))


@query
def validation_checks(b: Bed) -> DataFrame:
    return tidy(cleaning.validation_checks(cleaning.clean_members(b.members), b.activity))


# --- labels -----------------------------------------------------------------------------------------


@query
def churn_labels(b: Bed) -> DataFrame:
    return tidy(b.labels, ID, "label_year_flights", "hard_churn", "activity_churn", "churned")


def _windowed(b: Bed, **options) -> DataFrame:
    return labels.record_window_labels(b.members, b.activity, b.settings.prediction_date, **options)


@query
def churn_labels_record_window(b: Bed) -> DataFrame:
    return tidy(
        _windowed(b), ID, "last_activity_date", "hard_churn", "activity_churn_6m",
        "activity_churn_12m", "churn",
    )


@query
def label_unfiltered_window(b: Bed) -> DataFrame:
    out = _windowed(b, months=(12,), combine_months=12, cutoff_filter=False)
    return tidy(out, ID, "last_activity_date", "activity_churn_12m", "churn")


@query
def churn_label_fallback(b: Bed) -> DataFrame:
    filled = labels.fallback_labels(b.labels, b.activity).withColumns({
        "fallback": F.col("churn"), "extreme": F.lit(1), "kept": F.col("churned"),
    })
    switched = labels.sane_labels(filled, "extreme", "fallback").drop("label_rate")
    return tidy(labels.sane_labels(switched, "kept", "fallback"), ID, "fallback", "extreme", "kept")


@query
def prediction_date(b: Bed) -> DataFrame:
    return tidy(labels.prediction_date(b.activity))


@query
def churn_definitions(b: Bed) -> DataFrame:
    return tidy(labels.churn_definitions(_windowed(b), {
        "Hard Churn": ("hard_churn", "Explicit cancellation"),
        "Activity Churn (6m)": ("activity_churn_6m", "No activity 6 months"),
        "Activity Churn (12m)": ("activity_churn_12m", "No activity 12 months"),
        "Combined Churn": ("churn", "Cancellation OR inactivity"),
    }))


@query
def churn_overlap(b: Bed) -> DataFrame:
    return tidy(labels.churn_overlap(b.labels))


@query
def leakage_audit(b: Bed) -> DataFrame:
    leaks = labels.leaking_members(_windowed(b), b.activity, b.settings.prediction_date, "churn")
    return tidy(leaks, ID, "last_activity_date", "hard_churn")


@query
def leak_count(b: Bed) -> DataFrame:
    leaking = labels.leaking_members(b.labels, b.activity, b.settings.prediction_date)
    return tidy(leaking.agg(F.count(F.lit(1)).alias("leaking")))


# --- features ---------------------------------------------------------------------------------------


@query
def activity_features(b: Bed) -> DataFrame:
    return tidy(features.activity_features(b.activity, b.settings))


@query
def member_features(b: Bed) -> DataFrame:
    return tidy(
        features.member_features(b.members, b.settings), ID, "tenure_months", "tier_numeric",
        "education_numeric", "is_female", "is_married", "is_promo_enrollment", "has_high_clv",
        "clv_log", "is_early_member", "is_recent_member", "province_code", *b.settings.province_flags,
    )


def _trailing(b: Bed, *names: str) -> DataFrame:
    return tidy(features.trailing_features(b.activity, b.settings.prediction_date), ID, *names)


@query
def rfm_features(b: Bed) -> DataFrame:
    rfm = features.trailing_features(b.activity, b.settings.prediction_date).join(
        b.members.select(ID, "clv"), ID, "left"
    )
    return tidy(rfm, ID, "recency_days", "total_flights", "active_months", "avg_flights_mo", "clv")


@query
def momentum_features(b: Bed) -> DataFrame:
    return _trailing(b, "flights_3m", "flights_6m", "momentum_ratio", "trend_direction")


@query
def volatility_features(b: Bed) -> DataFrame:
    return _trailing(b, "std_flights", "cv_flights", "consistency_score")


@query
def temporal_features(b: Bed) -> DataFrame:
    return _trailing(b, "summer_ratio", "holiday_ratio", "seasonality_score")


@query
def points_features(b: Bed) -> DataFrame:
    return _trailing(
        b, "total_earned", "total_redeemed", "redemption_rate", "earn_burn_ratio", "points_balance"
    )


@query
def trajectory_features(b: Bed) -> DataFrame:
    return _trailing(b, "flights_ly", "flights_py", "yoy_growth")


def _records(b: Bed) -> DataFrame:
    s = b.settings
    return features.record_features(b.activity, (s.feature_year, s.label_year))


@query
def record_features(b: Bed) -> DataFrame:
    return tidy(_records(b))


@query
def engagement_minmax(b: Bed) -> DataFrame:
    return tidy(b.features, ID, "engagement_health_score")


@query
def engagement_weighted(b: Bed) -> DataFrame:
    return tidy(features.engagement_weighted(_records(b)), ID, "engagement_health_score")


@query
def engagement_additive(b: Bed) -> DataFrame:
    matrix = features.trailing_matrix(_windowed(b), b.activity, b.settings.prediction_date)
    return tidy(matrix, ID, "engagement_score", "churn")


@query
def feature_matrix(b: Bed) -> DataFrame:
    return tidy(b.features.drop("last_activity_date"))


@query
def record_matrix(b: Bed) -> DataFrame:
    return tidy(features.record_matrix(b.members, b.activity, b.settings))


@query
def trailing_matrix(b: Bed) -> DataFrame:
    return tidy(features.trailing_matrix(_windowed(b), b.activity, b.settings.prediction_date))


@query
def feature_means(b: Bed) -> DataFrame:
    return tidy(features.feature_means(b.features, {
        "Flight Behavior": ["total_flights", "avg_flights_per_month", "flight_consistency",
                            "active_month_ratio", "max_flights_month"],
        "Distance": ["total_distance", "avg_distance_per_month"],
        "Points/Engagement": ["total_points_accumulated", "total_points_redeemed",
                              "redemption_rate", "points_balance"],
        "Recency": ["recency_months", "last_active_month"],
        "Momentum": ["momentum_h2_minus_h1", "q4_flights"],
        "Demographics": ["tier_numeric", "clv", "clv_log", "tenure_months", "engagement_health_score"],
    }))


# --- scaling and segments ---------------------------------------------------------------------------

SCALED = ["clv", "total_flights", "redemption_rate", "tier_numeric"]


@query
def minmax_scale(b: Bed) -> DataFrame:
    return tidy(stats.minmax_scale(b.features.select(ID, *SCALED), SCALED))


@query
def standard_scale(b: Bed) -> DataFrame:
    return tidy(stats.standard_scale(b.features.select(ID, *SCALED), SCALED))


@query
def segment_profiles(b: Bed) -> DataFrame:
    return tidy(segments.segment_profiles(
        b.scored, ["clv_log", "avg_flights_per_month", "redemption_rate", "active_month_ratio"], "churned"
    ))


@query
def segment_names_ranked(b: Bed) -> DataFrame:
    # twelve groups split over both sides of the activity threshold
    grouped = b.features.withColumn("segment_id", (F.col(ID) % 12).cast("int")).withColumn(
        "avg_flights_per_month",
        F.when(F.col("segment_id") % 2 == 0, F.col("avg_flights_per_month")).otherwise(0.0),
    )
    return tidy(segments.names_by_rank(segments.programme_profiles(grouped)))


@query
def names_by_rank(b: Bed) -> DataFrame:
    return tidy(
        segments.names_by_rank(segments.programme_profiles(b.scored)),
        "segment_id", "is_active", "clv_rank", "segment_name",
    )


def _staged_profiles(b: Bed) -> DataFrame:
    grouped = b.features.withColumn("segment_id", (F.col(ID) % 7).cast("int")).withColumns({
        "clv_percentile": F.col("clv"), "loyalty_health_score": F.col("engagement_health_score"),
        "recency_days": F.col("recency_months") * 30,
    })
    chosen = [
        "clv_percentile", "recency_days", "active_month_ratio", "redemption_rate",
        "avg_flights_per_month", "loyalty_health_score",
    ]
    return segments.segment_profiles(grouped, chosen, "churned")


@query
def percent_rank_profiles(b: Bed) -> DataFrame:
    ranked = segments.staged_rules(_staged_profiles(b))
    return tidy(ranked, "segment_id", *[c for c in ranked.columns if c.endswith("_rank")])


@query
def segment_rules(b: Bed) -> DataFrame:
    ruled = segments.staged_rules(_staged_profiles(b))
    return tidy(ruled.withColumn("rule", F.col("candidates")[0]), "segment_id", "size", "rule")


def _module_profiles(b: Bed) -> DataFrame:
    matrix = features.trailing_matrix(_windowed(b), b.activity, b.settings.prediction_date)
    grouped = matrix.withColumn("segment_id", (F.col(ID) % 7).cast("int"))
    return grouped.groupBy("segment_id").agg(*[F.avg(c).alias(c) for c in segments.MODULE_FEATURES])


@query
def segment_rules_absolute(b: Bed) -> DataFrame:
    ruled = segments.module_rules(_module_profiles(b))
    return tidy(ruled.withColumn("rule", F.col("candidates")[0]), "segment_id", "clv_rank", "engagement_rank", "rule")


@query
def unique_names(b: Bed) -> DataFrame:
    staged = segments.unique_names(segments.staged_rules(_staged_profiles(b)))
    module = segments.unique_names(
        segments.module_rules(_module_profiles(b)), list(offers.ARCHETYPES), "Segment"
    ).withColumnRenamed("segment_name", "module_name")
    return tidy(staged.join(module, "segment_id"))


@query
def segment_archetypes(b: Bed) -> DataFrame:
    sizes = b.staged.groupBy("segment_name").agg(F.count(F.lit(1)).alias("members"))
    both = [
        segments.attach_archetypes(sizes, staged).withColumn("variant", F.lit("staged" if staged else "module"))
        for staged in (False, True)
    ]
    return tidy(both[0].unionByName(both[1]))


@query
def nearest_centroid(b: Bed) -> DataFrame:
    scaled = stats.minmax_scale(b.scored.select(ID, "segment_id", *SCALED), SCALED)
    centres = scaled.groupBy("segment_id").agg(*[F.round(F.avg(c), 4).alias(c) for c in SCALED])
    return tidy(segments.nearest_centroid(scaled, SCALED, centres), ID, "segment_id")


# --- evaluation of a fixed score --------------------------------------------------------------------


def _judged(b: Bed) -> DataFrame:
    cut = b.scored.select(ID, F.col("churned").alias("label"), F.col("churn_probability").alias("probability"))
    return evaluation.predicted(cut, "probability")


@query
def class_weights(b: Bed) -> DataFrame:
    return tidy(models.class_counts(b.labels, "churned"))


@query
def confusion(b: Bed) -> DataFrame:
    return tidy(evaluation.confusion(_judged(b)))


@query
def classification_metrics(b: Bed) -> DataFrame:
    return tidy(evaluation.classification_metrics(_judged(b)))


@query
def class_report(b: Bed) -> DataFrame:
    return tidy(evaluation.class_report(_judged(b)))


@query
def roc_auc(b: Bed) -> DataFrame:
    return tidy(evaluation.roc_auc(_judged(b)))


@query
def roc_curve(b: Bed) -> DataFrame:
    return tidy(evaluation.roc_curve(_judged(b)))


@query
def metric_translation(b: Bed) -> DataFrame:
    return tidy(evaluation.translate(evaluation.evaluate(_judged(b).drop("prediction"))))


# --- risk and retention -----------------------------------------------------------------------------


@query
def risk_bands(b: Bed) -> DataFrame:
    p = F.col("churn_probability")
    return tidy(b.scored.select(
        ID, "churn_probability", "risk_level",
        retention.risk_level(p, include_zero=True).alias("risk_level_zero"),
        retention.risk_level(p, retention.STAGED_CUTS, retention.STAGED_BANDS).alias("risk_level_staged"),
    ))


@query
def revenue_at_risk(b: Bed) -> DataFrame:
    whole = retention.revenue_at_risk(F.col("clv"), F.col("churn_probability"))
    return tidy(b.scored.withColumn("revenue_whole", whole), ID, "revenue_at_risk", "potential_save", "revenue_whole")


@query
def offers_staged(b: Bed) -> DataFrame:
    return tidy(
        retention.staged_recommendations(b.staged), ID, "seg_name", "risk_key", "recommended_action",
        "recommended_offer", "recommended_channel", "intervention_timing", "lift",
    )


@query
def offers_module(b: Bed) -> DataFrame:
    return tidy(
        retention.module_recommendations(b.staged), ID, "risk_level", "action", "offer", "channel",
        "timing", "lift", "revenue_at_risk", "potential_save", "priority_score",
    )


@query
def clv_delog(b: Bed) -> DataFrame:
    logged = b.members.select(ID, F.log1p("clv").alias("clv_log"), F.col("clv"))
    plain = retention.clv_estimate(logged, "clv").withColumnRenamed("clv_estimate", "from_plain")
    both = retention.clv_estimate(plain.drop("clv_top"), "clv_log").withColumnRenamed("clv_estimate", "from_log")
    rounded = both.withColumn("from_log", F.round("from_log", 2))
    return tidy(retention.clv_estimate(rounded, None), ID, "from_plain", "from_log", "clv_estimate")


@query
def priority_scores(b: Bed) -> DataFrame:
    return tidy(
        retention.staged_recommendations(b.staged), ID, "clv_estimate", "revenue_at_risk",
        "potential_save", "priority_score",
    )


@query
def action_list(b: Bed) -> DataFrame:
    actions = retention.action_list(retention.programme_actions(b.scored))
    return tidy(retention.filter_actions(
        actions, risks=["High", "Medium"], segments=["Miles Hoarders", "Premium Dormant"], tiers=["Star", "Nova"],
    ))


@query
def sorted_actions(b: Bed) -> DataFrame:
    return tidy(retention.action_list(retention.programme_actions(b.scored)))


@query
def priority_top100(b: Bed) -> DataFrame:
    top = retention.top_rows(retention.module_recommendations(b.staged), "priority_score", 100)
    return tidy(top, ID, "priority_score", "action")


@query
def top_priority(b: Bed) -> DataFrame:
    high = b.scored.where(F.col("risk_level") == "High")
    return tidy(
        retention.top_rows(high, "revenue_at_risk", 15), ID, "loyalty_card", "segment_name",
        "churn_probability", "clv", "revenue_at_risk", "potential_save", "engagement_health_score",
    )


@query
def display_formats(b: Bed) -> DataFrame:
    return b.scored.select(
        ID, exprs.as_percent(F.col("churn_probability")).alias("probability"),
        exprs.as_short_money(F.col("revenue_at_risk")).alias("revenue"),
    )


@query
def first_n(b: Bed) -> DataFrame:
    return tidy(b.members.orderBy(ID).limit(100), ID, "loyalty_card")


@query
def playbook(b: Bed) -> DataFrame:
    return tidy(retention.playbook(retention.staged_recommendations(b.staged)))


@query
def risk_summary(b: Bed) -> DataFrame:
    return tidy(reports.portfolio_summary(retention.staged_recommendations(b.staged)))


@query
def recommendation_summary(b: Bed) -> DataFrame:
    recommended = retention.staged_recommendations(b.staged)
    by_risk = reports.recommendation_summary(recommended, "risk_level").withColumnRenamed("risk_level", "level")
    by_name = reports.recommendation_summary(recommended, "seg_name").withColumnRenamed("seg_name", "level")
    return tidy(by_risk.unionByName(by_name))


# --- reports ----------------------------------------------------------------------------------------


@query
def segment_heatmap(b: Bed) -> DataFrame:
    chosen = [
        "avg_flights_per_month", "active_month_ratio", "recency_months", "redemption_rate",
        "engagement_health_score", "tenure_months", "tier_numeric", "clv_log",
        "dollar_cost_per_flight", "q4_flights",
    ]
    return tidy(reports.normalised_means(b.scored, "segment_name", chosen))


@query
def portfolio_kpis(b: Bed) -> DataFrame:
    return tidy(reports.portfolio_kpis(b.scored))


@query
def segment_drilldown(b: Bed) -> DataFrame:
    return tidy(reports.segment_drilldown(b.scored, "Premium Dormant"))


@query
def metric_table(b: Bed) -> DataFrame:
    return tidy(reports.metric_table(b.labels, b.activity))


@query
def activity_profile(b: Bed) -> DataFrame:
    date = F.lit(b.settings.prediction_date).cast("date")
    return tidy(reports.activity_profile(b.activity, date))


@query
def segment_summary(b: Bed) -> DataFrame:
    return tidy(reports.segment_summary(b.scored))


@query
def segment_revenue(b: Bed) -> DataFrame:
    return tidy(reports.segment_revenue(b.scored))


@query
def province_stats(b: Bed) -> DataFrame:
    return tidy(reports.segment_summary(b.scored, "province"))


@query
def min_support_provinces(b: Bed) -> DataFrame:
    return tidy(reports.min_support(reports.churn_by(b.labels, "province"), 50))


@query
def cohort_stats(b: Bed) -> DataFrame:
    return tidy(reports.cohort_stats(b.scored))


@query
def rate_bands(b: Bed) -> DataFrame:
    rate = F.col("churn_rate")
    return tidy(reports.churn_by(b.labels, "province").withColumns({
        "province_band": reports.rate_band(rate, 0.18, 0.13),
        "cohort_band": reports.rate_band(rate, 0.20, 0.13),
        "segment_band": reports.rate_band(rate, 0.25, 0.10),
    }))


@query
def extreme_groups(b: Bed) -> DataFrame:
    return tidy(reports.extremes(reports.churn_by(b.labels, "province"), "province", "churn_rate"))


@query
def report_facts(b: Bed) -> DataFrame:
    return tidy(reports.report_facts(b.scored))


@query
def risk_value_quadrants(b: Bed) -> DataFrame:
    return tidy(reports.risk_value_quadrants(reports.segment_summary(b.scored)))


@query
def category_order(b: Bed) -> DataFrame:
    order = ["High School or Below", "College", "Bachelor", "Master"]
    return tidy(reports.category_order(reports.churn_by(b.labels, "education"), "education", order))


@query
def filter_choices(b: Bed) -> DataFrame:
    return tidy(reports.filter_choices(b.scored, ["segment_name", "loyalty_card", "province", "risk_level"]))


@query
def sampled_scatter(b: Bed) -> DataFrame:
    sample = reports.hashed_sample(b.scored, 100, b.settings.seed)
    return tidy(sample, ID, "clv", "churn_probability", "segment_name", "revenue_at_risk")


@query
def summary_document(b: Bed) -> DataFrame:
    return reports.summary_document(b.scored)


@query
def summary_document_rows(b: Bed) -> DataFrame:
    return tidy(reports.document_rows(reports.summary_document(b.scored)))


# --- stored tables: partitioned by year, bucketed by member ------------------------------------------


@query
def stored_activity_features(b: Bed) -> DataFrame:
    return tidy(features.activity_features(b.store.activity, b.settings))


@query
def stored_churn_labels(b: Bed) -> DataFrame:
    labelled = labels.churn_labels(b.store.members, b.store.activity, b.settings)
    return tidy(labelled, ID, "hard_churn", "label_year_flights", "activity_churn", "churned")


@query
def stored_leakage_audit(b: Bed) -> DataFrame:
    date = b.settings.prediction_date
    windowed = labels.record_window_labels(b.store.members, b.store.activity, date)
    leaking = labels.leaking_members(windowed, b.store.activity, date, "churn")
    return tidy(leaking, ID, "last_activity_date", "hard_churn")


@query
def stored_feature_matrix(b: Bed) -> DataFrame:
    return tidy(features.labelled_matrix(b.store.members, b.store.activity, b.settings))
