"""Risk bands, revenue at risk, offers and priorities for scored members."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import attach, band, lookup, money_sum
from tidemark.operators import offers as dims
from tidemark.settings import Settings

PROGRAMME_BANDS = ("Low", "Medium", "High")
STAGED_BANDS = ("Low Risk", "Medium Risk", "High Risk")
STAGED_CUTS = (0.30, 0.60)


def risk_level(
    probability: Column, cuts: tuple[float, float] = (0.40, 0.70),
    labels: tuple[str, ...] = PROGRAMME_BANDS, include_zero: bool = False,
) -> Column:
    """Right-closed bands. A probability of exactly 0 lies outside them: NULL, or the lowest band
    with `include_zero`."""
    banded = band(probability, cuts, labels, None)
    return F.when(probability == 0, labels[0]).otherwise(banded) if include_zero else banded


def revenue_at_risk(clv: Column, probability: Column, factor: float = 1.0) -> Column:
    """Cents are rounded in decimal arithmetic, so a half cent rounds the same way everywhere."""
    exact = clv.cast("decimal(20,4)") * probability.cast("decimal(12,10)") * F.lit(factor).cast("decimal(4,2)")
    return F.round(exact, 2).cast("double")


def saved(revenue: Column, rate: Column) -> Column:
    return F.round(revenue.cast("decimal(18,2)") * rate.cast("decimal(4,2)"), 2).cast("double")


def score_revenue(scored: DataFrame, settings: Settings) -> DataFrame:
    """Add `risk_level`, `revenue_at_risk` and `potential_save` where they are missing."""
    p = F.col("churn_probability")
    wanted = {
        "risk_level": risk_level(p, settings.risk_cuts),
        "revenue_at_risk": revenue_at_risk(F.col("clv"), p, settings.revenue_factor),
        "potential_save": saved(F.col("revenue_at_risk"), F.lit(settings.save_rate)),
    }
    out = scored
    for name, expression in wanted.items():
        if name not in out.columns:
            out = out.withColumn(name, expression)
    return out


def assign_offers(
    scored: DataFrame, library: DataFrame, segments: Iterable[str], default_segment: str,
    segment: Column, risk: Column, default_risk: str,
) -> DataFrame:
    """Join the offer of (segment, risk). Unknown keys are mapped to the defaults first, so one
    broadcast join of a fixed dimension answers the two-level lookup."""
    known = F.coalesce(segment.isin(*segments), F.lit(False))
    graded = F.coalesce(risk.isin(*_risks(risk_default=default_risk)), F.lit(False))
    keyed = scored.withColumns({
        "_segment": F.when(known, segment).otherwise(default_segment),
        "_risk": F.when(graded, risk).otherwise(default_risk),
    })
    dimension = library.withColumnsRenamed({"segment": "_segment", "risk": "_risk"})
    return keyed.join(F.broadcast(dimension), ["_segment", "_risk"], "left").drop("_segment", "_risk")


def _risks(risk_default: str) -> tuple[str, ...]:
    return PROGRAMME_BANDS if risk_default in PROGRAMME_BANDS else dims.RISK_LEVELS


def programme_actions(scored: DataFrame) -> DataFrame:
    """Offers by segment and band; other segments get the regulars' offers, no band the low one."""
    return assign_offers(
        scored, dims.programme_offers(scored.sparkSession), dims.PROGRAMME_OFFERS, "Engaged Regulars",
        F.col("segment_name"), F.col("risk_level"), "Low",
    )


ACTION_COLUMNS = {
    "loyalty_number": "loyalty_number", "loyalty_card": "loyalty_card", "province": "province",
    "segment_name": "segment_name", "risk_level": "risk_level",
    "churn_probability": "churn_probability", "clv": "clv", "revenue_at_risk": "revenue_at_risk",
    "potential_save": "potential_save", "action": "recommended_action", "offer": "specific_offer",
    "channel": "channel", "timing": "timing", "incentive_cost": "incentive_cost_cad",
    "avg_flights_per_month": "avg_flights_per_month", "recency_months": "recency_months",
    "engagement_health_score": "engagement_health_score", "tenure_months": "tenure_months",
}


def action_list(with_offers: DataFrame) -> DataFrame:
    """High and medium risk members, most revenue at risk first."""
    at_risk = with_offers.where(F.col("risk_level").isin("High", "Medium"))
    ordered = at_risk.orderBy(F.desc("revenue_at_risk"), "loyalty_number")
    return ordered.select(*[F.col(c).alias(name) for c, name in ACTION_COLUMNS.items()])


def filter_actions(
    actions: DataFrame, risks: Iterable[str] = (), segments: Iterable[str] = (),
    tiers: Iterable[str] = (), provinces: Iterable[str] = (),
) -> DataFrame:
    """Conjunction of the choices made; an empty choice does not filter."""
    chosen = {
        "risk_level": risks, "segment_name": segments, "loyalty_card": tiers, "province": provinces,
    }
    out = actions
    for name, values in chosen.items():
        values = list(values)
        if values and name in actions.columns:
            out = out.where(F.col(name).isin(values))
    return out


def clv_estimate(df: DataFrame, column: str | None = "clv", default: float = 5000.0) -> DataFrame:
    """`clv_estimate` and `clv_top`, its largest value. CLV is taken back from log scale where
    its largest value is under 20."""
    if column is None or column not in df.columns:
        return df.withColumns({"clv_estimate": F.lit(default), "clv_top": F.lit(default)})
    largest = df.agg(F.max(column).cast("double").alias("_largest"))

    def plain(x: Column) -> Column:
        return F.when(F.col("_largest") < 20, F.expm1(x)).otherwise(x)

    estimates = {"clv_estimate": plain(F.col(column)), "clv_top": plain(F.col("_largest"))}
    return attach(df, largest).withColumns(estimates).drop("_largest")


def _staged_risk(scored: DataFrame) -> DataFrame:
    """`risk_level` as it stands; derived where there is none, or the column holds nothing."""
    derived = risk_level(F.col("churn_probability"), STAGED_CUTS, STAGED_BANDS)
    if "risk_level" not in scored.columns:
        return scored.withColumn("risk_level", derived)
    known = scored.agg(F.count("risk_level").alias("_known"))
    kept = F.when(F.col("_known") > 0, F.col("risk_level")).otherwise(derived)
    return attach(scored, known).withColumn("risk_level", kept).drop("_known")


def staged_recommendations(scored: DataFrame) -> DataFrame:
    """Offer, lift, revenue, save and priority per member, by the 8 x 3 library. A risk level that the table
    has is kept."""
    spark = scored.sparkSession
    p = F.col("churn_probability")
    named = {"Low Risk": "low", "Medium Risk": "medium", "High Risk": "high"}
    keyed = clv_estimate(_staged_risk(scored)).withColumns({
        "seg_name": F.coalesce("segment_name", F.lit("DEFAULT")),
    }).withColumn("risk_key", lookup(F.col("risk_level"), named, "medium"))
    offered = assign_offers(
        keyed, dims.staged_offers(spark), dims.STAGED_OFFERS, "DEFAULT",
        F.col("seg_name"), F.col("risk_key"), "medium",
    ).withColumnsRenamed({
        "action": "recommended_action", "offer": "recommended_offer",
        "channel": "recommended_channel", "timing": "intervention_timing",
    })
    lifted = expected_lift(offered)
    rar = revenue_at_risk(F.col("clv_estimate"), p)
    priority = 0.4 * p + 0.4 * (F.col("clv_estimate") / F.col("clv_top")) + 0.2 * F.col("lift")
    return (
        lifted.withColumn("revenue_at_risk", rar)
        .withColumn("potential_save", saved(F.col("revenue_at_risk"), F.col("lift")))
        .withColumn("priority_score", F.round(priority, 4))
        .drop("clv_top")
    )


def expected_lift(df: DataFrame, segment: str = "seg_name", risk: str = "risk_key") -> DataFrame:
    """`lift` of (segment, risk), or the risk's default."""
    table = dims.lift_table(df.sparkSession).withColumnsRenamed({"segment": segment, "risk": risk})
    joined = df.join(F.broadcast(table), [segment, risk], "left")
    fallback = lookup(F.col(risk), dims.DEFAULT_LIFT, dims.DEFAULT_LIFT["medium"])
    return joined.withColumn("lift", F.coalesce("lift", fallback))


def module_recommendations(scored: DataFrame) -> DataFrame:
    """The 7 x 3 library with one lift per risk; unknown risk takes the high offer. A risk level that the table
    has is kept."""
    spark = scored.sparkSession
    p = F.col("churn_probability")
    top = scored.agg(F.greatest(F.max("clv"), F.lit(1.0)).alias("_top"))
    graded = attach(scored, top)
    if "risk_level" not in scored.columns:
        graded = graded.withColumn("risk_level", risk_level(p, STAGED_CUTS, dims.RISK_LEVELS))
    risk = F.lower("risk_level")
    offered = assign_offers(
        graded, dims.module_offers(spark), dims.MODULE_OFFERS, "Silent Drifters",
        F.col("segment_name"), risk, "high",
    )
    lifted = offered.withColumn("lift", lookup(risk, dims.RISK_LIFT, 0.18))
    share = F.col("clv") / F.col("_top")
    priority = 0.4 * p + 0.4 * share + 0.2 * (F.col("lift") / dims.RISK_LIFT["high"])
    return (
        lifted.withColumn("revenue_at_risk", revenue_at_risk(F.col("clv"), p))
        .withColumn("potential_save", saved(F.col("revenue_at_risk"), F.col("lift")))
        .withColumn("priority_score", F.round(priority, 4))
        .drop("_top")
    )


def top_rows(df: DataFrame, measure: str, count: int, tie_break: str = "loyalty_number") -> DataFrame:
    """Each task keeps its best `count`; the driver-side merge sees no more than that per task."""
    return df.orderBy(F.desc(measure), tie_break).limit(count)


def playbook(recommended: DataFrame) -> DataFrame:
    """Every (segment, risk) intervention with the segment's size, mean risk and money."""
    spark = recommended.sparkSession
    sized = recommended.groupBy(F.col("seg_name").alias("segment")).agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("churn_probability").alias("avg_churn_probability"),
        money_sum("revenue_at_risk").alias("revenue_at_risk"),
        money_sum("potential_save").alias("potential_save"),
    )
    plays = dims.staged_offers(spark).where(F.col("segment") != "DEFAULT")
    lifts = dims.lift_table(spark)
    measured = [c for c in sized.columns if c != "segment"]
    return (
        plays.join(F.broadcast(lifts), ["segment", "risk"], "left")
        .join(sized, "segment", "left")
        .fillna(0, subset=measured)
        .withColumn("expected_lift", F.format_string("%.0f%%", F.coalesce("lift", F.lit(0.20)) * 100))
        .drop("lift")
    )


def playbook_document(recommended: DataFrame) -> DataFrame:
    """The playbook nested as one row per segment: measures and a risk -> intervention map."""
    flat = playbook(recommended)
    play = F.struct("action", "offer", "channel", "timing", "expected_lift")
    return flat.groupBy(
        "segment", "size", "avg_churn_probability", "revenue_at_risk", "potential_save"
    ).agg(F.map_from_entries(F.collect_list(F.struct("risk", play))).alias("interventions"))
