"""The registered queries again as SQL, for a side-by-side check on another engine.

Shared steps are named common table expressions; `statement` puts the ones a query names, and the
ones those name, in front of it.
"""

from __future__ import annotations

import re

from tidemark.operators import offers
from tidemark.plans.bed import PROGRAMME_SEGMENTS, STAGED_SEGMENTS


def ints(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


def nums(*names: str) -> str:
    return ", ".join(num(n, n) for n in names)


def num(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + 0.0 AS {name}"


def integer(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def clip(x: str, low: str, high: str) -> str:
    return f"CASE WHEN {x} < {low} THEN {low} WHEN {x} > {high} THEN {high} ELSE {x} END"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# The archetypes that the check expects, of the segments that its rows have
_BOTH_ARCHETYPES = [
    ("Premium Loyalists", "High CLV, stable engagement, consistent flyers",
     "VIP treatment, exclusive benefits, personal relationship manager", "Personal outreach + Premium app features",
     "Lounge access, priority boarding, milestone rewards", "Low — maintain relationship"),
    ("Silent Drifters", "Declining engagement, once-active customers going quiet",
     "Urgent re-engagement — act within 30 days", "Email + SMS + In-app push",
     "5,000 bonus miles for next booking + tier extension", "HIGH — imminent churn risk"),
]
_ARCHETYPES = [(v, *a) for v in ("module", "staged") for a in _BOTH_ARCHETYPES] + [
    ("module", "At-Risk VIPs", "Previously high-value customers showing sharp decline",
     "Maximum intervention — executive outreach justified", "Personal call + priority email + lounge invitation",
     "Tier retention + 20K miles + dedicated account manager", "CRITICAL — losing these customers is most costly"),
    ("staged", "At-Risk VIPs", "Previously high-value customers showing sharp decline",
     "Maximum intervention — executive outreach justified", "Personal call + Email + Premium offer",
     "Tier extension 12 months + 15K bonus miles + lounge pass", "CRITICAL — high revenue at risk"),
]


def literal_rows(rows: list[tuple], names: str) -> str:
    def cell(v) -> str:
        return text(v) if isinstance(v, str) else repr(v)

    values = ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {values}) AS t({names})"


def case_of(expression: str, table: dict, other: str) -> str:
    arms = " ".join(f"WHEN {k} THEN {text(v) if isinstance(v, str) else v}" for k, v in table.items())
    return f"CASE {expression} {arms} ELSE {other} END"


def by_id(names: list[str]) -> str:
    return case_of("loyalty_number % 4", dict(enumerate(names[:-1])), text(names[-1]))


PREDICTION = "DATE '2000-12-31'"
AT = "make_date(year, month, 1)"

CTES = {
    "history": f"""
        SELECT o_custkey, min(o_orderdate) AS first_date,
               sum(CASE WHEN o_orderdate <= {PREDICTION} THEN CAST(o_totalprice AS DECIMAL(12,2)) END) AS spent
        FROM orders GROUP BY o_custkey""",
    "member": """
        SELECT c_custkey AS loyalty_number, n_name AS province,
               CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
               CASE c_custkey % 5 WHEN 0 THEN 'High School or Below' WHEN 1 THEN 'College'
                    WHEN 2 THEN 'Bachelor' WHEN 3 THEN 'Master' ELSE 'Doctor' END AS education,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal * 10 END AS salary,
               CASE c_custkey % 3 WHEN 0 THEN 'Married' WHEN 1 THEN 'Single' ELSE 'Divorced' END AS marital_status,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Star'
                    WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Nova' ELSE 'Aurora' END AS loyalty_card,
               coalesce(CAST(spent AS DOUBLE), 0.0) AS clv,
               CASE WHEN c_custkey % 17 = 0 THEN 'Promotion' ELSE 'Standard' END AS enrollment_type,
               year(first_date) AS enrollment_year, month(first_date) AS enrollment_month,
               CASE WHEN c_custkey % 26 = 0 THEN 2001 END AS cancellation_year,
               CASE WHEN c_custkey % 26 = 0 THEN 1 + c_custkey % 7 END AS cancellation_month
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN history ON c_custkey = o_custkey""",
    "line_totals": """
        SELECT l_orderkey, sum(l_quantity) AS distance,
               CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2))), 2) AS DOUBLE) AS points_accumulated,
               CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE)
                   AS points_redeemed,
               CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
                   * CAST(l_tax AS DECIMAL(4,2))), 2) AS DOUBLE) AS dollar_cost_points_redeemed
        FROM lineitem GROUP BY l_orderkey""",
    "activity_raw": """
        SELECT o_orderkey AS record_id, o_custkey AS loyalty_number, year(o_orderdate) AS year,
               month(o_orderdate) AS month, 1 AS total_flights, coalesce(distance, 0) AS distance,
               coalesce(points_accumulated, 0) AS points_accumulated,
               coalesce(points_redeemed, 0) AS points_redeemed,
               coalesce(dollar_cost_points_redeemed, 0) AS dollar_cost_points_redeemed
        FROM orders LEFT JOIN line_totals ON o_orderkey = l_orderkey""",
    "activity": """
        SELECT loyalty_number, year, month, CAST(sum(total_flights) AS BIGINT) AS total_flights,
               sum(distance) AS distance, sum(points_accumulated) AS points_accumulated,
               sum(points_redeemed) AS points_redeemed,
               sum(dollar_cost_points_redeemed) AS dollar_cost_points_redeemed
        FROM activity_raw GROUP BY 1, 2, 3""",
    "days": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders",
    "quarters": "SELECT DISTINCT year(date) AS year, month(date) AS month, quarter(date) AS quarter FROM days",
    "labelled": f"""
        SELECT m.*, coalesce(f.flights, 0) AS label_year_flights,
               {flag("cancellation_year IS NOT NULL AND cancellation_year >= 2001")} AS hard_churn,
               {flag("coalesce(f.flights, 0) = 0")} AS activity_churn,
               {flag("(cancellation_year IS NOT NULL AND cancellation_year >= 2001) OR coalesce(f.flights, 0) = 0")}
                   AS churned
        FROM member m LEFT JOIN (SELECT loyalty_number, sum(total_flights) AS flights FROM activity
                                 WHERE year = 2001 GROUP BY 1) f USING (loyalty_number)""",
    "last_seen": f"""
        SELECT loyalty_number, max({AT}) AS last_activity_date FROM activity
        WHERE {AT} <= {PREDICTION} GROUP BY 1""",
    "windowed": f"""
        SELECT m.*, last_activity_date, {flag("cancellation_year IS NOT NULL")} AS hard_churn,
               {flag(f"last_activity_date IS NULL OR last_activity_date < {PREDICTION} - INTERVAL 6 MONTH")}
                   AS activity_churn_6m,
               {flag(f"last_activity_date IS NULL OR last_activity_date < {PREDICTION} - INTERVAL 12 MONTH")}
                   AS activity_churn_12m,
               {flag(f"cancellation_year IS NOT NULL OR last_activity_date IS NULL "
                     f"OR last_activity_date < {PREDICTION} - INTERVAL 6 MONTH")} AS churn
        FROM member m LEFT JOIN last_seen USING (loyalty_number)""",
    "salary_filled": f"""
        SELECT loyalty_number, {flag("salary IS NULL")} AS salary_missing,
               CASE WHEN salary IS NULL OR salary < 0
                    THEN (SELECT quantile_cont(salary, 0.5) FROM member) ELSE salary END AS salary
        FROM member""",
    "year_totals": """
        SELECT loyalty_number, CAST(sum(total_flights) AS BIGINT) AS total_flights,
               avg(total_flights) AS avg_flights_per_month, max(total_flights) AS max_flights_month,
               coalesce(stddev_samp(total_flights), 0) AS flight_std, sum(distance) AS total_distance,
               avg(distance) AS avg_distance_per_month, sum(points_accumulated) AS total_points_accumulated,
               sum(points_redeemed) AS total_points_redeemed, avg(points_accumulated) AS avg_points_per_month,
               sum(dollar_cost_points_redeemed) AS total_dollar_cost_redeemed,
               count(*) FILTER (total_flights > 0) AS active_months, count(*) AS months_recorded,
               max(month) AS last_active_month,
               coalesce(sum(total_flights) FILTER (month >= 7) - sum(total_flights) FILTER (month <= 6), 0)
                   AS momentum_h2_minus_h1,
               coalesce(sum(total_flights) FILTER (month >= 10), 0) AS q4_flights,
               coalesce(sum(total_flights) FILTER (month <= 3), 0) AS q1_flights
        FROM activity WHERE year = 2000 GROUP BY 1""",
    "year_features": f"""
        SELECT *, greatest(12 - last_active_month, 0) AS recency_months, active_months / 12 AS active_month_ratio,
               1 - {clip("flight_std / (avg_flights_per_month + 1e-6)", "0", "1")} AS flight_consistency,
               {clip("total_points_redeemed / (total_points_accumulated + 1e-6)", "0", "1")} AS redemption_rate,
               greatest(total_dollar_cost_redeemed / (total_flights + 1e-6), 0) AS dollar_cost_per_flight,
               greatest(total_points_accumulated - total_points_redeemed, 0) AS points_balance
        FROM year_totals""",
    "member_encoded": f"""
        SELECT loyalty_number,
               greatest(2000 * 12 + 12 - (enrollment_year * 12 + enrollment_month), 0) AS tenure_months,
               CASE loyalty_card WHEN 'Star' THEN 1 WHEN 'Nova' THEN 2 WHEN 'Aurora' THEN 3 ELSE 1 END AS tier_numeric,
               CASE education WHEN 'High School or Below' THEN 1 WHEN 'College' THEN 2 WHEN 'Bachelor' THEN 3
                    WHEN 'Master' THEN 4 WHEN 'Doctor' THEN 5 ELSE 2 END AS education_numeric,
               {flag("gender = 'Female'")} AS is_female, {flag("marital_status = 'Married'")} AS is_married,
               {flag("enrollment_type = 'Promotion'")} AS is_promo_enrollment,
               {flag("clv > (SELECT quantile_cont(clv, 0.75) FROM member)")} AS has_high_clv,
               ln(1 + clv) AS clv_log, {flag("enrollment_year <= 1995")} AS is_early_member,
               {flag("enrollment_year >= 1997")} AS is_recent_member,
               CASE WHEN province IN ({", ".join(f"'NATION_{i}'" for i in range(11))})
                    THEN CAST(replace(province, 'NATION_', '') AS INTEGER) + 1 ELSE 0 END AS province_code,
               {flag("province = 'NATION_0'")} AS is_ontario, {flag("province = 'NATION_1'")} AS is_bc,
               {flag("province = 'NATION_2'")} AS is_quebec, {flag("province = 'NATION_3'")} AS is_alberta
        FROM member""",
    "matrix": """
        SELECT l.* EXCLUDE (salary), s.salary, s.salary_missing, e.* EXCLUDE (loyalty_number),
               COLUMNS(y.* EXCLUDE (loyalty_number))
        FROM labelled l JOIN salary_filled s USING (loyalty_number) JOIN member_encoded e USING (loyalty_number)
        LEFT JOIN year_features y USING (loyalty_number)""",
    "spans": """
        SELECT min(recency_months) AS rec_lo, max(recency_months) AS rec_hi, min(active_month_ratio) AS act_lo,
               max(active_month_ratio) AS act_hi, min(flight_consistency) AS con_lo, max(flight_consistency) AS con_hi,
               min(redemption_rate) AS red_lo, max(redemption_rate) AS red_hi, min(tier_numeric) AS tier_lo,
               max(tier_numeric) AS tier_hi FROM zero_filled""",
    "features": """
        SELECT z.*, round((coalesce(1 - (recency_months - rec_lo) / nullif(rec_hi - rec_lo, 0), 0)
                         + coalesce((active_month_ratio - act_lo) / nullif(act_hi - act_lo, 0), 0)
                         + coalesce((flight_consistency - con_lo) / nullif(con_hi - con_lo, 0), 0)
                         + coalesce((redemption_rate - red_lo) / nullif(red_hi - red_lo, 0), 0)
                         + coalesce((tier_numeric - tier_lo) / nullif(tier_hi - tier_lo, 0), 0)) / 5 * 100, 1)
                   AS engagement_health_score
        FROM zero_filled z, spans""",
    "risk": f"""
        SELECT *, round({clip("1 - engagement_health_score / 100", "0", "1")}, 4) AS churn_probability,
               loyalty_number % 4 AS segment_id,
               CAST(clv AS DECIMAL(16,2)) * CAST(round({clip("1 - engagement_health_score / 100", "0", "1")}, 4)
                   AS DECIMAL(6,4)) AS whole FROM features""",
    "scored": f"""
        SELECT *, {by_id(PROGRAMME_SEGMENTS)} AS segment_name,
               CASE WHEN churn_probability > 0 AND churn_probability <= 0.4 THEN 'Low'
                    WHEN churn_probability > 0.4 AND churn_probability <= 0.7 THEN 'Medium'
                    WHEN churn_probability > 0.7 AND churn_probability <= 1 THEN 'High' END AS risk_level,
               CAST(round(whole * 0.82, 2) AS DOUBLE) AS revenue_at_risk,
               CAST(round(round(whole * 0.82, 2) * 0.27, 2) AS DOUBLE) AS potential_save,
               CAST(round(whole, 2) AS DOUBLE) AS revenue_whole
        FROM risk""",
    "programme": literal_rows(
        offers.offer_rows(offers.PROGRAMME_OFFERS), "segment, risk, action, offer, channel, timing, incentive_cost"
    ),
    "with_programme": f"""
        SELECT s.*, action, offer, channel, timing, incentive_cost FROM scored s LEFT JOIN programme p
        ON p.segment = CASE WHEN segment_name IN ({", ".join(map(text, offers.PROGRAMME_OFFERS))})
                            THEN segment_name ELSE 'Engaged Regulars' END
        AND p.risk = coalesce(risk_level, 'Low')""",
    "actions": """
        SELECT loyalty_number, loyalty_card, province, segment_name, risk_level, churn_probability, clv,
               revenue_at_risk, potential_save, action AS recommended_action, offer AS specific_offer, channel,
               timing, incentive_cost AS incentive_cost_cad, avg_flights_per_month, recency_months,
               engagement_health_score, tenure_months
        FROM with_programme WHERE risk_level IN ('High', 'Medium')""",
    "staged_library": literal_rows(
        offers.offer_rows(offers.STAGED_OFFERS), "segment, risk, action, offer, channel, timing"
    ),
    "lifts": literal_rows(offers.lift_rows(), "segment, risk, lift"),
    "staged_keys": f"""
        SELECT *, {by_id(STAGED_SEGMENTS)} AS seg_name,
               CASE WHEN churn_probability > 0 AND churn_probability <= 0.3 THEN 'Low Risk'
                    WHEN churn_probability > 0.3 AND churn_probability <= 0.6 THEN 'Medium Risk'
                    WHEN churn_probability > 0.6 AND churn_probability <= 1 THEN 'High Risk' END AS risk_level,
               CASE WHEN churn_probability > 0 AND churn_probability <= 0.3 THEN 'low'
                    WHEN churn_probability > 0.6 AND churn_probability <= 1 THEN 'high' ELSE 'medium' END AS risk_key
        FROM risk""",
    "staged": """
        SELECT k.*, o.action AS recommended_action, o.offer AS recommended_offer, o.channel AS recommended_channel,
               o.timing AS intervention_timing,
               coalesce(l.lift, CASE risk_key WHEN 'low' THEN 0.10 WHEN 'medium' THEN 0.22 ELSE 0.30 END)
                   AS lift,
               clv AS clv_estimate, CAST(round(whole, 2) AS DOUBLE) AS revenue_at_risk,
               CAST(round(round(whole, 2) * CAST(coalesce(l.lift, CASE risk_key WHEN 'low' THEN 0.10
                     WHEN 'medium' THEN 0.22 ELSE 0.30 END) AS DECIMAL(4,2)), 2) AS DOUBLE) AS potential_save,
               round(CAST(0.4 AS DOUBLE) * churn_probability
                   + CAST(0.4 AS DOUBLE) * (clv / (SELECT max(clv) FROM risk))
                   + CAST(0.2 AS DOUBLE) * CAST(coalesce(l.lift, CASE risk_key WHEN 'low' THEN 0.10
                     WHEN 'medium' THEN 0.22 ELSE 0.30 END) AS DOUBLE), 4) AS priority_score
        FROM staged_keys k
        LEFT JOIN lifts l ON l.segment = seg_name AND l.risk = risk_key
        LEFT JOIN staged_library o ON o.risk = risk_key AND o.segment =
            CASE WHEN seg_name IN (SELECT segment FROM staged_library) THEN seg_name ELSE 'DEFAULT' END""",
    "module_library": literal_rows(
        offers.offer_rows(offers.MODULE_OFFERS), "segment, risk, action, offer, channel, timing"
    ),
    "module_keys": f"""
        SELECT *, {by_id(STAGED_SEGMENTS)} AS seg_name,
               CASE WHEN churn_probability > 0 AND churn_probability <= 0.3 THEN 'low'
                    WHEN churn_probability > 0.3 AND churn_probability <= 0.6 THEN 'medium'
                    WHEN churn_probability > 0.6 AND churn_probability <= 1 THEN 'high' END AS risk_level
        FROM risk""",
    "module_lifted": """
        SELECT k.*, action, offer, channel, timing,
               CAST(CASE risk_level WHEN 'low' THEN 0.08 WHEN 'high' THEN 0.28 ELSE 0.18 END AS DOUBLE) AS lift,
               CAST(round(whole, 2) AS DOUBLE) AS revenue_at_risk
        FROM module_keys k LEFT JOIN module_library o ON o.risk = coalesce(risk_level, 'high') AND o.segment =
            CASE WHEN seg_name IN (SELECT segment FROM module_library) THEN seg_name ELSE 'Silent Drifters' END""",
    "module": """
        SELECT *, CAST(round(round(whole, 2) * CAST(lift AS DECIMAL(4,2)), 2) AS DOUBLE) AS potential_save,
               round(CAST(0.4 AS DOUBLE) * churn_probability
                   + CAST(0.4 AS DOUBLE) * (clv / (SELECT greatest(max(clv), 1.0) FROM risk))
                   + CAST(0.2 AS DOUBLE) * (lift / CAST(0.28 AS DOUBLE)), 4) AS priority_score
        FROM module_lifted""",
    "judged": f"""
        SELECT loyalty_number, churned AS label, churn_probability AS probability,
               {flag("churn_probability >= 0.5")} AS prediction FROM scored""",
    "outcomes": """
        SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
               count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn
        FROM judged""",
    "metrics": """
        SELECT tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
               coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
               coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM outcomes""",
    "auc": """
        SELECT sum(label) AS positives, sum(1 - label) AS negatives,
               (sum(label * mean_rank) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) AS roc_auc
        FROM (SELECT label, rank() OVER (ORDER BY probability)
                     + (count(*) OVER (PARTITION BY probability) - 1) / 2 AS mean_rank FROM judged)""",
    "trailing_totals": f"""
        SELECT loyalty_number, date_diff('day', max({AT}), {PREDICTION}) AS recency_days,
               sum(total_flights) AS total_flights, count(DISTINCT {AT}) AS active_months,
               coalesce(sum(total_flights) FILTER ({AT} > {PREDICTION} - INTERVAL 3 MONTH), 0) AS flights_3m,
               coalesce(sum(total_flights) FILTER ({AT} > {PREDICTION} - INTERVAL 6 MONTH), 0) AS flights_6m,
               coalesce(stddev_samp(total_flights), 0) AS std_flights, avg(total_flights) AS mean_flights,
               coalesce(sum(total_flights) FILTER (month IN (6, 7, 8)), 0) AS summer,
               coalesce(sum(total_flights) FILTER (month IN (11, 12, 1)), 0) AS holiday,
               sum(points_accumulated) AS total_earned, sum(points_redeemed) AS total_redeemed,
               sum(total_flights) FILTER ({AT} > {PREDICTION} - INTERVAL 12 MONTH) AS ly,
               sum(total_flights) FILTER ({AT} > {PREDICTION} - INTERVAL 24 MONTH
                                          AND {AT} <= {PREDICTION} - INTERVAL 12 MONTH) AS py
        FROM activity WHERE {AT} <= {PREDICTION} GROUP BY 1""",
    "lookback": f"""
        SELECT *, total_flights / greatest(active_months, 1) AS avg_flights_mo,
               {clip("flights_3m / greatest(flights_6m, 1)", "0", "5")} AS momentum_ratio,
               {flag("flights_3m / greatest(flights_6m, 1) > 1")} AS trend_direction,
               std_flights / greatest(mean_flights, 0.01) AS cv_flights,
               1 / (1 + std_flights / greatest(mean_flights, 0.01)) AS consistency_score,
               summer / greatest(total_flights, 1) AS summer_ratio, holiday / greatest(total_flights, 1) AS holiday_ratio,
               summer / greatest(total_flights, 1) + holiday / greatest(total_flights, 1) AS seasonality_score,
               {clip("total_redeemed / greatest(total_earned, 1)", "0", "1")} AS redemption_rate,
               {clip("total_earned / greatest(total_redeemed, 1)", "0", "100")} AS earn_burn_ratio,
               greatest(total_earned - total_redeemed, 0) AS points_balance,
               CASE WHEN ly IS NOT NULL OR py IS NOT NULL THEN coalesce(ly, 0) END AS flights_ly,
               CASE WHEN ly IS NOT NULL OR py IS NOT NULL THEN coalesce(py, 0) END AS flights_py,
               CASE WHEN ly IS NOT NULL OR py IS NOT NULL THEN
                   {clip("(coalesce(ly, 0) - coalesce(py, 0)) / greatest(coalesce(py, 0), 1)", "-2", "5")}
               END AS yoy_growth
        FROM trailing_totals""",
    "trailing_scored": f"""
        SELECT t.* EXCLUDE (flights_ly, flights_py, yoy_growth), clv, churn,
               coalesce(flights_ly, 0) AS flights_ly, coalesce(flights_py, 0) AS flights_py,
               coalesce(yoy_growth, 0) AS yoy_growth,
               coalesce(CASE WHEN yoy_growth IS NOT NULL THEN greatest(least(
                   50 + 20 * (1 - {clip("recency_days", "0", "365")} / 365) + 20 * consistency_score
                   + 20 * redemption_rate + 10 * trend_direction + 10 * {clip("yoy_growth", "-1", "1")},
                   100), 0) END, 0) AS engagement_score
        FROM lookback t LEFT JOIN windowed USING (loyalty_number)""",
    "data_end": f"SELECT max({AT}) AS last_date, max({AT}) - INTERVAL 3 MONTH AS prediction_date FROM activity",
    "record_totals": f"""
        SELECT loyalty_number, sum(total_flights) AS total_flights, sum(distance) AS total_distance,
               count(DISTINCT {AT}) AS active_months, (max(year) - min(year)) * 12 + max(month) AS months_recorded,
               max(total_flights) AS max_flights_month, coalesce(stddev_samp(total_flights), 0) AS flight_std,
               sum(points_accumulated) AS total_points_accumulated, sum(points_redeemed) AS total_points_redeemed,
               max({AT}) AS last_date,
               coalesce(sum(total_flights) FILTER (year = 2001), 0)
                   - coalesce(sum(total_flights) FILTER (year = 2000), 0) AS momentum_h2_minus_h1,
               coalesce(sum(total_flights) FILTER (month IN (10, 11, 12)), 0) AS q4_flights
        FROM activity GROUP BY 1""",
    "record_rates": f"""
        SELECT r.* EXCLUDE (last_date), total_flights / greatest(active_months, 1) AS avg_flights_per_month,
               total_distance / greatest(active_months, 1) AS avg_distance_per_month,
               active_months / greatest(months_recorded, 1) AS active_month_ratio,
               total_points_accumulated / greatest(active_months, 1) AS avg_points_per_month,
               {clip("total_points_redeemed / greatest(total_points_accumulated, 1)", "0", "1")} AS redemption_rate,
               greatest(total_points_accumulated - total_points_redeemed, 0) AS points_balance,
               round(greatest(date_diff('day', r.last_date, CAST(d.prediction_date AS DATE))
                     / CAST(30.44 AS DOUBLE), 0), 1) AS recency_months,
               month(r.last_date) AS last_active_month,
               CASE WHEN total_flights > 0 THEN
                   1 - {clip("flight_std / greatest(total_flights / greatest(active_months, 1), 0.01)", "0", "1")}
                   ELSE 0 END AS flight_consistency
        FROM record_totals r, data_end d""",
    "record_seen": f"""
        SELECT loyalty_number, max({AT}) FILTER ({AT} <= CAST(d.prediction_date AS DATE)) AS last_activity_date,
               max({AT}) AS recorded FROM activity, data_end d GROUP BY 1""",
    "record_windows": f"""
        SELECT m.*, s.last_activity_date, {flag("cancellation_year IS NOT NULL")} AS hard_churn,
               {flag("s.last_activity_date IS NULL OR s.last_activity_date < CAST(d.prediction_date AS DATE) - INTERVAL 6 MONTH")}
                   AS activity_churn_6m,
               {flag("s.last_activity_date IS NULL OR s.last_activity_date < CAST(d.prediction_date AS DATE) - INTERVAL 12 MONTH")}
                   AS activity_churn_12m,
               {flag("cancellation_year IS NOT NULL OR recorded IS NULL OR recorded < (SELECT max(make_date(year, month, 1)) FROM activity) - INTERVAL 6 MONTH")}
                   AS fallback,
               greatest(year(CAST(d.prediction_date AS DATE)) * 12 + month(CAST(d.prediction_date AS DATE))
                        - (enrollment_year * 12 + enrollment_month), 0) AS tenure
        FROM member m LEFT JOIN record_seen s USING (loyalty_number), data_end d""",
    "record_matrix_rows": f"""
        SELECT w.* EXCLUDE (salary, tenure, fallback), s.salary, s.salary_missing, w.tenure AS tenure_months,
               e.* EXCLUDE (loyalty_number, tenure_months), COALESCE(COLUMNS(r.* EXCLUDE (loyalty_number)), 0),
               CASE WHEN (SELECT avg(greatest(hard_churn, activity_churn_6m)) FROM record_windows) BETWEEN 0.02 AND 0.9
                    THEN greatest(hard_churn, activity_churn_6m) ELSE fallback END AS churn
        FROM record_windows w JOIN salary_filled s USING (loyalty_number) JOIN member_encoded e USING (loyalty_number)
        LEFT JOIN record_rates r USING (loyalty_number)""",
    "grouped_profiles": """
        SELECT loyalty_number % 7 AS segment_id, count(*) AS size, avg(clv) AS clv, avg(recency_months * 30) AS recency,
               avg(active_month_ratio) AS engagement, avg(redemption_rate) AS redemption,
               avg(avg_flights_per_month) AS frequency, avg(engagement_health_score) AS health,
               avg(churned) * 100 AS churn FROM features GROUP BY 1""",
    "profile_ranks": "SELECT segment_id, size, " + ", ".join(
        f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2) / count(*) OVER () AS {c}_rank"
        for c in ("clv", "churn", "recency", "engagement", "redemption", "frequency", "health")
    ) + ", 0.5 AS trend_rank FROM grouped_profiles",
    "module_profiles": """
        SELECT loyalty_number % 7 AS segment_id, avg(clv) AS clv, avg(engagement_score) AS engagement,
               avg(recency_days) AS recency, avg(redemption_rate) AS redemption, avg(momentum_ratio) AS momentum,
               avg(seasonality_score) AS seasonality FROM trailing_scored GROUP BY 1""",
    "module_ranks": "SELECT *, " + ", ".join(
        f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2) / count(*) OVER () AS {c}_rank"
        for c in ("clv", "engagement")
    ) + " FROM module_profiles",
    "segment_groups": """
        SELECT segment_name, count(*) AS members, avg(churned) AS churn_rate, avg(clv) AS avg_clv,
               avg(engagement_health_score) AS avg_engagement, sum(CAST(revenue_at_risk AS DECIMAL(18,2))) AS revenue_at_risk,
               avg(revenue_at_risk) AS avg_revenue_at_risk FROM scored GROUP BY 1""",
    "province_groups": """
        SELECT province, count(*) AS members, avg(churned) AS churn_rate, avg(clv) AS avg_clv,
               avg(engagement_health_score) AS avg_engagement, sum(CAST(revenue_at_risk AS DECIMAL(18,2))) AS revenue_at_risk
        FROM scored GROUP BY 1""",
    "cohorts": """
        SELECT enrollment_year, count(*) AS members, avg(churned) AS churn_rate, avg(clv) AS avg_clv,
               avg(engagement_health_score) AS avg_engagement FROM scored GROUP BY 1""",
    "scaled": "SELECT loyalty_number, segment_id, " + ", ".join(
        f"coalesce((f.{c} - (SELECT min({c}) FROM scored)) / nullif((SELECT max({c}) - min({c}) FROM scored), 0), 0) AS {c}"
        for c in ("clv", "total_flights", "redemption_rate", "tier_numeric")
    ) + " FROM scored f",
}

# the feature year's columns are 0 for a member without rows in it
_YEAR_COLUMNS = [
    "total_flights", "avg_flights_per_month", "max_flights_month", "flight_std", "total_distance",
    "avg_distance_per_month", "total_points_accumulated", "total_points_redeemed", "avg_points_per_month",
    "total_dollar_cost_redeemed", "active_months", "months_recorded", "last_active_month",
    "momentum_h2_minus_h1", "q4_flights", "q1_flights", "recency_months", "active_month_ratio",
    "flight_consistency", "redemption_rate", "dollar_cost_per_flight", "points_balance",
]
_WHOLE = [
    "total_flights", "max_flights_month", "active_months", "months_recorded", "last_active_month",
    "momentum_h2_minus_h1", "q4_flights", "q1_flights", "recency_months",
]
_REAL = [c for c in _YEAR_COLUMNS if c not in _WHOLE]
_ENCODED = [
    "tenure_months", "tier_numeric", "education_numeric", "is_female", "is_married", "is_promo_enrollment",
    "has_high_clv", "is_early_member", "is_recent_member", "province_code", "is_ontario", "is_bc",
    "is_quebec", "is_alberta",
]
CTES["zero_filled"] = (
    "SELECT l.* EXCLUDE (salary), s.salary, s.salary_missing, e.* EXCLUDE (loyalty_number), "
    + ", ".join(f"coalesce(y.{c}, 0) AS {c}" for c in _YEAR_COLUMNS)
    + " FROM labelled l JOIN salary_filled s USING (loyalty_number) JOIN member_encoded e USING (loyalty_number)"
    + " LEFT JOIN year_features y USING (loyalty_number)"
)
del CTES["matrix"]


# The published training columns
_TRAINED = [
    "recency_months", "active_month_ratio", "avg_flights_per_month", "redemption_rate", "clv_log", "tenure_months",
    "active_months", "q4_flights", "total_distance", "momentum_h2_minus_h1", "flight_consistency",
    "total_points_accumulated", "salary", "salary_missing", "engagement_health_score", "points_balance", "tier_numeric",
    "education_numeric", "is_female", "is_married", "is_promo_enrollment", "dollar_cost_per_flight", "is_early_member",
    "is_recent_member", "is_ontario", "is_bc", "is_quebec",
]
# The columns of the published clustering
_CLUSTERED = [
    "avg_flights_per_month", "recency_months", "active_month_ratio", "redemption_rate", "clv_log", "tier_numeric",
    "tenure_months", "engagement_health_score", "momentum_h2_minus_h1", "total_distance", "dollar_cost_per_flight", "q4_flights",
]


def _components() -> str:
    """Both components by squaring the covariance matrix until one direction is left; the second after deflation."""
    d = len(_CLUSTERED)
    z = {c: f"(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ())" for c in _CLUSTERED}
    covariances = ", ".join(f"covar_pop({a}, {b})" for a in _CLUSTERED for b in _CLUSTERED)

    def squared(m: str) -> str:
        return (f"list_transform(range({d * d}), lambda i: list_sum(list_transform(range({d}), "
                f"lambda k: {m}[(i // {d}) * {d} + k + 1] * {m}[k * {d} + i % {d} + 1])))")

    def trace(m: str) -> str:
        return f"list_sum(list_transform(range({d}), lambda i: {m}[i * {d} + i + 1]))"

    def steps(name: str, start: str) -> str:
        return (f"{name}_power AS (SELECT 0 AS step, m FROM {start} UNION ALL SELECT step + 1, "
                f"list_transform(s, lambda v: v / {trace('s')}) FROM (SELECT step, {squared('m')} AS s FROM {name}_power WHERE step < 45)), "
                f"{name}_raw AS (SELECT list_transform(range({d}), lambda i: m[peak * {d} + i + 1] / sqrt(m[peak * {d} + peak + 1])) AS v FROM "
                f"(SELECT m, list_position(g, list_max(g)) - 1 AS peak FROM (SELECT m, list_transform(range({d}), lambda i: m[i * {d} + i + 1]) AS g "
                f"FROM {name}_power WHERE step = 45))), "
                f"{name} AS (SELECT list_transform(v, lambda x: x * sign(v[list_position(list_transform(v, lambda y: abs(y)), "
                f"list_max(list_transform(v, lambda y: abs(y))))])) AS v FROM {name}_raw), "
                f"{name}_value AS (SELECT list_sum(list_transform(range({d * d}), lambda i: m[i + 1] * v[i // {d} + 1] * v[i % {d} + 1])) AS e "
                f"FROM {start}, {name})")

    shown = ", ".join(f"{e} AS {c}" for c, e in z.items())
    vector = f"[{', '.join(_CLUSTERED)}]"
    return f"""WITH RECURSIVE z AS (SELECT loyalty_number, {shown} FROM features),
        covariance AS (SELECT [{covariances}] AS m FROM z), {steps("lead", "covariance")},
        remainder AS (SELECT list_transform(range({d * d}), lambda i: m[i + 1] - e * v[i // {d} + 1] * v[i % {d} + 1]) AS m
                 FROM covariance, lead, lead_value), {steps("next_lead", "remainder")}
        SELECT {integer("loyalty_number", "loyalty_number")}, {num(f"list_inner_product({vector}, f.v)", "pc1")},
               {num(f"list_inner_product({vector}, s.v)", "pc2")}, {num(f"fv.e / {trace('c.m')}", "explained_1")},
               {num(f"sv.e / {trace('c.m')}", "explained_2")}
        FROM z, lead f, next_lead s, lead_value fv, next_lead_value sv, covariance c"""


def statement(select: str) -> str:
    """The query with the common table expressions it needs, each after the ones it reads."""
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", sql):
                need(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    need(select)
    if not ordered:
        return select
    if select.startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + ",\n" + select.removeprefix("WITH RECURSIVE ")
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + select


def _log_counts() -> str:
    parts = ["SELECT 'fill_missing' AS step, 'loyalty' AS dataset, 'province' AS \"column\", 'Unknown' AS method, "
             "count(*) FILTER (loyalty_number % 9 = 0 OR province IS NULL) AS n FROM member"]
    for c in ("gender", "education", "marital_status", "loyalty_card", "enrollment_type"):
        parts.append(f"SELECT 'fill_missing', 'loyalty', '{c}', 'Unknown', count(*) FILTER ({c} IS NULL) FROM member")
    for c in ("salary", "clv", "enrollment_year", "enrollment_month"):
        parts.append(f"SELECT 'fill_missing', 'loyalty', '{c}', 'median', count(*) FILTER ({c} IS NULL) FROM member")
    parts.append("SELECT 'fix_negative_clv', 'loyalty', NULL, NULL, count(*) FILTER (clv <= 0) FROM member")
    parts.append("SELECT 'remove_duplicates', 'activity', NULL, NULL, "
                 "count(*) - count(DISTINCT (loyalty_number, year, month)) FROM activity_raw")
    return " UNION ALL ".join(parts)


_MEMBER_COLUMNS = [
    "loyalty_number", "province", "gender", "education", "salary", "marital_status", "loyalty_card", "clv",
    "enrollment_type", "enrollment_year", "enrollment_month", "cancellation_year", "cancellation_month",
]
_DIMENSIONS = ["loyalty_card", "gender", "education", "marital_status", "province", "enrollment_year"]
_HEAT = [
    "avg_flights_per_month", "active_month_ratio", "recency_months", "redemption_rate",
    "engagement_health_score", "tenure_months", "tier_numeric", "clv_log", "dollar_cost_per_flight", "q4_flights",
]
_CORRELATED = [
    "clv", "tenure_months", "total_flights", "active_month_ratio", "redemption_rate", "q4_flights",
    "recency_months", "engagement_health_score", "points_balance",
]
_MATRIX = ["clv", "total_flights", "redemption_rate", "recency_months", "churned"]
_MEANS = {
    "Flight Behavior": ["total_flights", "avg_flights_per_month", "flight_consistency", "active_month_ratio",
                        "max_flights_month"],
    "Distance": ["total_distance", "avg_distance_per_month"],
    "Points/Engagement": ["total_points_accumulated", "total_points_redeemed", "redemption_rate", "points_balance"],
    "Recency": ["recency_months", "last_active_month"],
    "Momentum": ["momentum_h2_minus_h1", "q4_flights"],
    "Demographics": ["tier_numeric", "clv", "clv_log", "tenure_months", "engagement_health_score"],
}
_DRILL = [
    "churned", "clv", "avg_flights_per_month", "recency_months", "active_month_ratio", "redemption_rate",
    "engagement_health_score", "tenure_months",
]
_SUMMARISED = ["salary", "clv", "enrollment_year", "cancellation_month"]


def _ranked(source: str, keys: str) -> str:
    high = "CASE least(clv_rank, 4) WHEN 1 THEN 'Active Champions' WHEN 2 THEN 'Miles Hoarders' " \
           "WHEN 3 THEN 'Engaged Regulars' ELSE 'Budget Fliers' END"
    low = "CASE least(clv_rank, 3) WHEN 1 THEN 'Premium Dormant' WHEN 2 THEN 'Seasonal Travelers' " \
          "ELSE 'Inactive Low-Value' END"
    means = {"avg_flights": "avg_flights_per_month", "recency": "recency_months", "active_ratio": "active_month_ratio",
             "churn_rate": "churned", "avg_clv": "clv", "avg_dist": "total_distance"}
    profile = ", ".join(f"round(avg({c}), 3) AS {n}" for n, c in means.items())
    return (
        f"SELECT {keys} FROM (SELECT *, CASE WHEN is_active = 1 THEN {high} ELSE {low} END AS segment_name FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY is_active ORDER BY avg_clv DESC, segment_id) AS clv_rank FROM ("
        f"SELECT *, {flag('avg_flights >= 0.5')} AS is_active FROM ("
        f"SELECT segment_id, {profile}, count(*) AS members FROM {source} GROUP BY segment_id))))"
    )


def _profile(where: str) -> str:
    return (
        f"SELECT {where} AS level, {integer('count(*)', 'members')}, {num('avg(churn_probability)', 'avg_probability')}, "
        f"{num('sum(CAST(revenue_at_risk AS DECIMAL(18,2)))', 'revenue_at_risk')}, {num('sum(CAST(potential_save AS DECIMAL(18,2)))', 'potential_save')} "
        f"FROM staged GROUP BY 1"
    )


_SELECTS = {
    # projection, filters, helpers
    "projection_renames": f"""SELECT loyalty_number, province, loyalty_card AS tier, {nums("clv")},
        {num("clv / 1000", "clv_thousands")} FROM member""",
    "column_helpers": f"""SELECT loyalty_number, {integer("cancellation_year", "cancelled_in")}, {nums("salary", "clv")},
        {ints("enrollment_year")}, {num("0", "recency")}, {integer(flag("clv > 0"), "has_clv")} FROM member""",
    "activity_filters": f"""SELECT loyalty_number, {ints("month", "total_flights")},
        {integer(flag("total_flights > 1 OR points_redeemed > 0"), "either")},
        {integer(flag("total_flights > 1 AND points_redeemed > 0"), "both")},
        {integer(flag("NOT total_flights > 1"), "neither_high")}
        FROM activity WHERE year = 2000 AND month BETWEEN 4 AND 9 AND month IN (6, 7, 8) AND loyalty_number IN
        (SELECT loyalty_number FROM member WHERE cancellation_year IS NULL AND salary IS NOT NULL)""",
    "cutoff_filter": f"SELECT {ints('loyalty_number', 'year', 'month', 'total_flights')} FROM activity "
                     f"WHERE {AT} <= {PREDICTION}",
    "trailing_windows": f"SELECT {ints('loyalty_number', 'flights_3m', 'flights_6m', 'flights_ly', 'flights_py')} "
                        f"FROM lookback",
    "null_to_zero": f"""SELECT loyalty_number, {nums("salary")}, {integer("coalesce(f, 0)", "flights")},
        {num("coalesce(d, 0)", "miles")} FROM member LEFT JOIN (SELECT loyalty_number, sum(total_flights) AS f,
        sum(distance) AS d FROM activity WHERE year = 2000 GROUP BY 1) USING (loyalty_number)""",
    # joins
    "member_activity_join": f"""SELECT loyalty_number, loyalty_card, {ints("flights", "last_year")} FROM member LEFT JOIN
        (SELECT loyalty_number, sum(total_flights) AS flights, max(year) AS last_year FROM activity GROUP BY 1)
        USING (loyalty_number)""",
    "calendar_join": f"""SELECT {ints("loyalty_number", "year", "month", "quarter", "total_flights")}
        FROM activity LEFT JOIN quarters USING (year, month) WHERE year = 2000""",
    "suffix_join": f"""SELECT loyalty_number, {ints("churned")},
        CASE WHEN loyalty_number % 5 <> 0 THEN province END AS province, province AS province_raw, province AS place
        FROM labelled""",
    "dict_lookup": f"""SELECT loyalty_number, {ints("tier_numeric", "education_numeric", "province_code")},
        {integer("label_year_flights", "flights")} FROM member_encoded JOIN labelled USING (loyalty_number)""",
    "two_level_lookup": f"""SELECT loyalty_number, segment_name, risk_level, action, offer, channel, timing,
        {ints("incentive_cost")} FROM with_programme""",
    "lift_lookup": f"SELECT loyalty_number, seg_name, risk_key, {nums('lift')} FROM staged",
    "key_union": f"""SELECT loyalty_number, {integer("coalesce(f, 0)", "flights")} FROM
        (SELECT loyalty_number FROM activity WHERE year = 2001 UNION SELECT loyalty_number FROM activity WHERE year = 2000)
        LEFT JOIN (SELECT loyalty_number, sum(total_flights) AS f FROM activity WHERE year = 2001 GROUP BY 1)
        USING (loyalty_number)""",
    "scalar_broadcast": f"""SELECT loyalty_number, {num("clv / (SELECT max(clv) FROM member)", "share_of_top")},
        {num("clv - (SELECT avg(clv) FROM member)", "above_mean")},
        {num("clv - (SELECT min(clv) FROM member)", "above_low")} FROM member""",
    # aggregates
    "activity_aggregates": f"""SELECT loyalty_number, {integer("sum(total_flights)", "flights")},
        {num("avg(distance)", "avg_distance")}, {num("max(points_accumulated)", "max_points")},
        {integer("count(total_flights)", "records")}, {num("coalesce(stddev_samp(distance), 0)", "distance_std")},
        {integer("count(*) FILTER (total_flights > 1)", "busy_months")},
        {integer("coalesce(max(month) FILTER (total_flights > 1), 0)", "last_busy_month")},
        {integer("count(DISTINCT year)", "years")}, CAST(min({AT}) AS VARCHAR) AS first_date,
        CAST(max({AT}) AS VARCHAR) AS last_date FROM activity GROUP BY 1""",
    "global_quantiles": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {num(str(p), 'prob')}, {integer(f'count({c})', 'n')}, "
        f"{num(f'quantile_cont({c}, {p})', 'value')} FROM member"
        for c in ("salary", "clv") for p in (0.01, 0.25, 0.5, 0.75, 0.99)
    ),
    "median_clv_by_group": f"""SELECT loyalty_card, {ints("churned")}, {integer("count(*)", "n")},
        {num("quantile_cont(clv, 0.5)", "median_clv")} FROM labelled GROUP BY loyalty_card, labelled.churned""",
    "flag_rates": "SELECT " + ", ".join(
        num(f"avg({c})", f"{c}_rate") for c in ("hard_churn", "activity_churn", "churned")) + " FROM labelled",
    "frequency_table": f"SELECT education, {integer('count(*)', 'members')} FROM member GROUP BY 1",
    "frequency_share": f"""SELECT risk_level, {integer("count(*)", "members")},
        {num("count(*) * 100.0 / sum(count(*)) OVER ()", "percent")} FROM scored GROUP BY 1""",
    "tier_churn_crosstab": f"""SELECT loyalty_card, {integer("count(*) FILTER (churned = 0)", "retained")},
        {integer("count(*) FILTER (churned = 1)", "churned")} FROM labelled GROUP BY 1""",
    "churn_by_tier": f"""SELECT loyalty_card, {integer("sum(churned)", "churned")}, {integer("count(*)", "members")},
        {num("avg(churned)", "churn_rate")} FROM labelled GROUP BY 1""",
    "churn_by_dimension_sets": " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS level, {integer('sum(churned)', 'churned')}, "
        f"{integer('count(*)', 'members')}, {num('avg(churned)', 'churn_rate')} FROM labelled GROUP BY 2"
        for d in _DIMENSIONS
    ),
    "monthly_totals": f"""SELECT CAST({AT} AS VARCHAR) AS activity_date,
        {integer("sum(total_flights)", "total_flights")} FROM activity GROUP BY 1""",
    "peak_months": f"""WITH m AS (SELECT {AT} AS d, sum(total_flights) AS f FROM activity GROUP BY 1)
        SELECT (SELECT strftime(d, '%Y-%m') FROM m ORDER BY f DESC, d LIMIT 1) AS busiest,
        {integer("(SELECT max(f) FROM m)", "busiest_flights")},
        (SELECT strftime(d, '%Y-%m') FROM m ORDER BY f, d LIMIT 1) AS quietest,
        {integer("(SELECT min(f) FROM m)", "quietest_flights")}""",
    "seasonality": f"SELECT {ints('month')}, {num('avg(total_flights)', 'avg_flights')} FROM activity GROUP BY activity.month",
    "activity_distribution": f"""SELECT {num("avg(f)", "avg_flights")}, {integer("max(f)", "max_flights")},
        {num("quantile_cont(f, 0.5)", "median_flights")} FROM
        (SELECT loyalty_number, CAST(sum(total_flights) AS BIGINT) AS f FROM activity GROUP BY 1)""",
    "numeric_summary": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {integer(f'count({c})', '\"count\"')}, {num(f'avg({c})', 'mean')}, "
        f"{num(f'stddev_samp({c})', 'std')}, {num(f'min({c})', '\"min\"')}, {num(f'max({c})', '\"max\"')}, "
        f"{num(f'quantile_cont({c}, 0.25)', 'p25')}, {num(f'quantile_cont({c}, 0.5)', 'p50')}, "
        f"{num(f'quantile_cont({c}, 0.75)', 'p75')} FROM member"
        for c in _SUMMARISED
    ),
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {integer(f'count(*) - count({c})', 'missing')}, "
        f"{num(f'(count(*) - count({c})) * 100.0 / count(*)', 'percent')} FROM member" for c in _MEMBER_COLUMNS
    ),
    "clv_histogram": f"""WITH span AS (SELECT min(clv) AS lo, (max(clv) - min(clv)) / 40 AS w FROM labelled),
        b AS (SELECT churned, CAST(least(floor((clv - lo) / w), 39) AS BIGINT) AS bin, lo, w FROM labelled, span)
        SELECT {ints("churned", "bin")}, {num("lo + bin * w", "bin_low")}, {num("lo + bin * w + w", "bin_high")},
        {integer("count(*)", "members")}, {num("count(*) / (sum(count(*)) OVER (PARTITION BY b.churned) * w)", "density")}
        FROM b GROUP BY b.churned, b.bin, lo, w""",
    "winsorised_clv": f"""SELECT loyalty_number, {num('''least(greatest(clv, (SELECT quantile_cont(clv, 0.01) FROM member)),
        (SELECT quantile_cont(clv, 0.99) FROM member))''', "clv")} FROM member""",
    "boxplot_stats": f"""WITH q AS (SELECT loyalty_card, quantile_cont(clv, 0.25) AS q1, quantile_cont(clv, 0.5) AS med,
        quantile_cont(clv, 0.75) AS q3 FROM member GROUP BY 1)
        SELECT loyalty_card, {nums("q1")}, {num("med", "median")}, {nums("q3")},
        {num("min(clv) FILTER (clv BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))", "whisker_low")},
        {num("max(clv) FILTER (clv BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))", "whisker_high")},
        {integer("count(*) FILTER (NOT clv BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))", "outliers")}
        FROM member JOIN q USING (loyalty_card) GROUP BY loyalty_card, q.q1, q.med, q.q3""",
    "churn_correlations": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {num(f'corr({c}, churned)', 'correlation')} FROM features" for c in _CORRELATED
    ),
    "correlation_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS row_feature, '{b}' AS column_feature, {num(f'corr({a}, {b})', 'correlation')} FROM features"
        for a in _MATRIX for b in _MATRIX
    ),
    # cleaning and quality
    "keep_first": f"""SELECT {ints("loyalty_number", "year", "month", "record_id")},
        {nums("distance", "points_accumulated")} FROM activity_raw QUALIFY row_number() OVER
        (PARTITION BY activity_raw.loyalty_number, activity_raw.year, activity_raw.month ORDER BY activity_raw.record_id) = 1""",
    "clean_members": f"""SELECT loyalty_number, CASE WHEN loyalty_number % 9 <> 0 THEN coalesce(province, 'Unknown')
        ELSE 'Unknown' END AS province, gender, education,
        {num("coalesce(salary, (SELECT quantile_cont(salary, 0.5) FROM member))", "salary")}, marital_status, loyalty_card,
        {num("CASE WHEN clv <= 0 THEN 1 ELSE clv END", "clv")}, enrollment_type,
        {num("coalesce(enrollment_year, (SELECT quantile_cont(enrollment_year, 0.5) FROM member))", "enrollment_year")},
        {num("coalesce(enrollment_month, (SELECT quantile_cont(enrollment_month, 0.5) FROM member))", "enrollment_month")},
        {ints("cancellation_year", "cancellation_month")},
        {num("ln(1 + CASE WHEN clv <= 0 THEN 1 ELSE clv END)", "clv_log")} FROM member""",
    "salary_fill": f"SELECT loyalty_number, {nums('salary')}, {ints('salary_missing')} FROM salary_filled",
    "clean_activity": f"""SELECT loyalty_number, CAST({AT} AS VARCHAR) AS activity_date, {ints("record_id", "total_flights")},
        {num("CASE WHEN record_id % 7 <> 0 THEN greatest(distance - 50, 0) ELSE 0 END", "distance")},
        {num("CASE WHEN record_id % 11 <> 0 THEN points_redeemed ELSE 0 END", "points_redeemed")}
        FROM activity_raw QUALIFY row_number() OVER
        (PARTITION BY activity_raw.loyalty_number, year, month ORDER BY activity_raw.record_id) = 1""",
    "calendar_quarters": f"SELECT {ints('year', 'month', 'quarter')} FROM quarters",
    "calendar_distinct": f"SELECT {ints('year', 'month')} FROM quarters",
    "age_clamp": f"SELECT loyalty_number, {integer('least(greatest(loyalty_number % 120, 18), 100)', 'member_age')} FROM member",
    "median_impute": f"""SELECT loyalty_number,
        {num("coalesce(salary, (SELECT quantile_cont(salary, 0.5) FROM member))", "salary")},
        {num("coalesce(cancellation_month, (SELECT quantile_cont(cancellation_month, 0.5) FROM member))", "cancellation_month")}
        FROM member""",
    "duplicate_audit": " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, {integer('sum(c)', '\"rows\"')}, {integer('count(*)', 'distinct_keys')}, "
        f"{integer('sum(c - 1)', 'duplicates')} FROM (SELECT count(*) AS c FROM {table} GROUP BY {keys})"
        for name, table, keys in (
            ("loyalty", "member", "loyalty_number"), ("activity", "activity_raw", "loyalty_number, year, month"),
            ("activity rows", "activity", "ALL"),
        )
    ).replace("SELECT count(*) AS c FROM activity GROUP BY ALL",
              "SELECT count(*) AS c FROM activity GROUP BY loyalty_number, year, month, total_flights, distance, "
              "points_accumulated, points_redeemed, dollar_cost_points_redeemed"),
    "cleaning_log": f"""SELECT step, dataset, "column", method, {integer("n", '"count"')}
        FROM ({_log_counts()}) WHERE n > 0""",
    "quality_issues": f"""SELECT * FROM (
        SELECT 'loyalty' AS dataset, 'missing_values' AS issue, 'medium' AS severity,
        {integer(" + ".join(f"(count(*) - count({c}))" for c in _MEMBER_COLUMNS), '"count"')} FROM member
        UNION ALL SELECT 'loyalty', 'negative_clv', 'high', count(*) FILTER (clv <= 0) FROM member
        UNION ALL SELECT 'loyalty', 'negative_salary', 'low', count(*) FILTER (salary < 0) FROM member
        UNION ALL SELECT 'both', 'potential_temporal_leakage', 'high', count(*) FROM member
        WHERE cancellation_year IS NOT NULL AND loyalty_number IN (SELECT loyalty_number FROM activity_raw)
        ) WHERE "count" > 0""",
    "validation_checks": f"""SELECT "check", {ints("failures")}, {integer(flag("failures = 0"), "passed")} FROM (
        SELECT 'loyalty_missing' AS "check",
        {" + ".join(f"(count(*) - count({c}))" for c in ("loyalty_number", "gender", "education"))} AS failures FROM member
        UNION ALL SELECT 'activity_missing', count(*) - count(total_flights) FROM activity
        UNION ALL SELECT 'loyalty_duplicate_rows', count(*) - count(DISTINCT loyalty_number) FROM member
        UNION ALL SELECT 'activity_duplicates', count(*) - count(DISTINCT (loyalty_number, year, month)) FROM activity)""",
    # labels
    "churn_labels": f"SELECT {ints('loyalty_number', 'label_year_flights', 'hard_churn', 'activity_churn', 'churned')} "
                    f"FROM labelled",
    "churn_labels_record_window": f"""SELECT loyalty_number, CAST(last_activity_date AS VARCHAR) AS last_activity_date,
        {ints("hard_churn", "activity_churn_6m", "activity_churn_12m", "churn")} FROM windowed""",
    "label_unfiltered_window": f"""SELECT loyalty_number, CAST(last AS VARCHAR) AS last_activity_date,
        {integer(flag(f"last IS NULL OR last < {PREDICTION} - INTERVAL 12 MONTH"), "activity_churn_12m")},
        {integer(flag(f"last IS NULL OR last < {PREDICTION} - INTERVAL 12 MONTH OR cancellation_year IS NOT NULL"), "churn")}
        FROM member LEFT JOIN (SELECT loyalty_number, max({AT}) AS last FROM activity GROUP BY 1) USING (loyalty_number)""",
    "churn_label_fallback": f"""WITH f AS (SELECT l.*, {flag('''last IS NULL OR last < (SELECT last_date FROM data_end)
        - INTERVAL 6 MONTH OR cancellation_year IS NOT NULL''')} AS fb FROM labelled l LEFT JOIN
        (SELECT loyalty_number, max({AT}) AS last FROM activity GROUP BY 1) USING (loyalty_number))
        SELECT loyalty_number, {integer("fb", "fallback")}, {integer("fb", "extreme")},
        {integer("CASE WHEN (SELECT avg(churned) FROM f) BETWEEN 0.02 AND 0.9 THEN churned ELSE fb END", "kept")} FROM f""",
    "prediction_date": """SELECT CAST(last_date AS VARCHAR) AS last_date,
        CAST(CAST(prediction_date AS DATE) AS VARCHAR) AS prediction_date FROM data_end""",
    "churn_definitions": " UNION ALL ".join(
        f"SELECT '{name}' AS definition, {integer(f'sum({c})', 'churned')}, "
        f"{num(f'sum({c}) * 100.0 / count(*)', 'rate')}, '{note}' AS description FROM windowed"
        for name, c, note in (
            ("Hard Churn", "hard_churn", "Explicit cancellation"),
            ("Activity Churn (6m)", "activity_churn_6m", "No activity 6 months"),
            ("Activity Churn (12m)", "activity_churn_12m", "No activity 12 months"),
            ("Combined Churn", "churn", "Cancellation OR inactivity"),
        )
    ),
    "churn_overlap": "SELECT " + ", ".join(
        integer(f"count(*) FILTER (hard_churn = {h} AND activity_churn = {a})", n)
        for n, h, a in (("hard_only", 1, 0), ("activity_only", 0, 1), ("both", 1, 1), ("neither", 0, 0))
    ) + " FROM labelled",
    "leakage_audit": f"""SELECT loyalty_number, CAST(last_activity_date AS VARCHAR) AS last_activity_date,
        {ints("hard_churn")} FROM windowed WHERE churn = 1 AND loyalty_number IN
        (SELECT loyalty_number FROM activity WHERE {AT} > {PREDICTION})""",
    "leak_count": f"""SELECT {integer(f'''(SELECT count(*) FROM labelled WHERE churned = 1 AND loyalty_number IN
        (SELECT loyalty_number FROM activity WHERE {AT} > {PREDICTION}))''', "leaking")}""",
    # features
    "activity_features": f"SELECT loyalty_number, {ints(*_WHOLE)}, {nums(*_REAL)} FROM year_features",
    "member_features": f"SELECT loyalty_number, {ints(*_ENCODED)}, {nums('clv_log')} FROM member_encoded",
    "rfm_features": f"""SELECT loyalty_number, {ints("recency_days", "total_flights", "active_months")},
        {nums("avg_flights_mo", "clv")} FROM lookback LEFT JOIN member USING (loyalty_number)""",
    "momentum_features": f"SELECT {ints('loyalty_number', 'flights_3m', 'flights_6m', 'trend_direction')}, "
                         f"{nums('momentum_ratio')} FROM lookback",
    "volatility_features": f"SELECT loyalty_number, {nums('std_flights', 'cv_flights', 'consistency_score')} FROM lookback",
    "temporal_features": f"SELECT loyalty_number, {nums('summer_ratio', 'holiday_ratio', 'seasonality_score')} FROM lookback",
    "points_features": f"""SELECT loyalty_number, {nums("total_earned", "total_redeemed", "redemption_rate",
        "earn_burn_ratio", "points_balance")} FROM lookback""",
    "trajectory_features": f"SELECT {ints('loyalty_number', 'flights_ly', 'flights_py')}, {nums('yoy_growth')} FROM lookback",
    "record_features": f"""SELECT {ints("loyalty_number", "total_flights", "active_months", "months_recorded",
        "max_flights_month", "momentum_h2_minus_h1", "q4_flights", "last_active_month")},
        {nums("total_distance", "flight_std", "total_points_accumulated", "total_points_redeemed",
        "avg_flights_per_month", "avg_distance_per_month", "active_month_ratio", "avg_points_per_month",
        "redemption_rate", "points_balance", "recency_months", "flight_consistency")} FROM record_rates""",
    "engagement_minmax": f"SELECT loyalty_number, {nums('engagement_health_score')} FROM features",
    "engagement_weighted": f"""SELECT loyalty_number, {num('''least(greatest(25 * (
        (1 - least(greatest(recency_months, 0), 24) / 24) + least(active_month_ratio, 1)
        + flight_consistency + redemption_rate), 0), 100)''', "engagement_health_score")} FROM record_rates""",
    "engagement_additive": f"SELECT loyalty_number, {nums('engagement_score')}, {ints('churn')} FROM trailing_scored",
    "feature_matrix": f"""SELECT {ints("loyalty_number", "enrollment_year", "enrollment_month", "cancellation_year",
        "cancellation_month", "label_year_flights", "hard_churn", "activity_churn", "churned", "salary_missing",
        *_ENCODED, *_WHOLE)}, province, gender, education, marital_status, loyalty_card, enrollment_type,
        {nums("salary", "clv", "clv_log", *_REAL, "engagement_health_score")} FROM features""",
    "record_matrix": f"""SELECT {ints("loyalty_number", "enrollment_year", "enrollment_month", "cancellation_year",
        "cancellation_month", "hard_churn", "activity_churn_6m", "activity_churn_12m", "churn", "salary_missing", *_ENCODED,
        "total_flights", "active_months", "months_recorded", "max_flights_month", "momentum_h2_minus_h1", "q4_flights",
        "last_active_month")}, CAST(last_activity_date AS VARCHAR) AS last_activity_date, province, gender, education,
        marital_status, loyalty_card, enrollment_type,
        {nums("salary", "clv", "clv_log", "total_distance", "flight_std", "total_points_accumulated", "total_points_redeemed",
        "avg_flights_per_month", "avg_distance_per_month", "active_month_ratio", "avg_points_per_month",
        "redemption_rate", "points_balance", "recency_months", "flight_consistency")},
        {num('''least(greatest(25 * ((1 - least(greatest(recency_months, 0), 24) / 24) + least(active_month_ratio, 1)
        + flight_consistency + redemption_rate), 0), 100)''', "engagement_health_score")} FROM record_matrix_rows""",
    "trailing_matrix": f"""SELECT {ints("loyalty_number", "recency_days", "total_flights", "active_months", "flights_3m",
        "flights_6m", "trend_direction", "flights_ly", "flights_py", "churn")}, {nums("std_flights", "total_earned",
        "total_redeemed", "avg_flights_mo", "momentum_ratio", "cv_flights", "summer_ratio", "holiday_ratio",
        "redemption_rate", "earn_burn_ratio", "points_balance", "yoy_growth", "consistency_score",
        "seasonality_score", "clv", "engagement_score")} FROM trailing_scored""",
    "feature_means": " UNION ALL ".join(
        f"SELECT '{g}' AS feature_group, '{c}' AS feature, {num(f'avg({c})', 'mean')} FROM features"
        for g, columns in _MEANS.items() for c in columns
    ),
    # scaling and segments
    "minmax_scale": f"SELECT loyalty_number, {nums('clv', 'total_flights', 'redemption_rate', 'tier_numeric')} FROM scaled",
    "standard_scale": "SELECT loyalty_number, " + ", ".join(
        num(f"({c} - (SELECT avg({c}) FROM features)) / (SELECT stddev_pop({c}) FROM features)", c)
        for c in ("clv", "total_flights", "redemption_rate", "tier_numeric")
    ) + " FROM features",
    "segment_profiles": f"""SELECT {ints("segment_id")}, {integer("count(*)", "size")}, {num("avg(clv_log)", "avg_clv_log")},
        {num("avg(avg_flights_per_month)", "avg_avg_flights_per_month")},
        {num("avg(redemption_rate)", "avg_redemption_rate")}, {num("avg(active_month_ratio)", "avg_active_month_ratio")},
        {num("avg(churned) * 100", "churn_rate_pct")}, {integer("sum(churned)", "churned_count")},
        {num("count(*) * 100.0 / sum(count(*)) OVER ()", "size_pct")} FROM scored GROUP BY scored.segment_id""",
    "segment_names_ranked": _ranked(
        "(SELECT * EXCLUDE (avg_flights_per_month), loyalty_number % 12 AS segment_id, "
        "CASE WHEN loyalty_number % 2 = 0 THEN avg_flights_per_month ELSE 0.0 END AS avg_flights_per_month FROM features)",
        f"{ints('segment_id', 'members', 'is_active', 'clv_rank')}, segment_name, "
        f"{nums('avg_flights', 'recency', 'active_ratio', 'churn_rate', 'avg_clv', 'avg_dist')}",
    ),
    "names_by_rank": _ranked("scored", f"{ints('segment_id', 'is_active', 'clv_rank')}, segment_name"),
    "percent_rank_profiles": f"SELECT {ints('segment_id')}, " + nums(*[
        f"{c}_rank" for c in ("clv", "churn", "recency", "engagement", "redemption", "frequency", "trend", "health")
    ]) + " FROM profile_ranks",
    "segment_rules": f"""SELECT {ints("segment_id", "size")},
        CASE WHEN clv_rank >= 0.6 AND churn_rank >= 0.65 THEN 'At-Risk VIPs'
             WHEN clv_rank >= 0.6 AND health_rank >= 0.6 AND churn_rank < 0.35 THEN 'Premium Loyalists'
             WHEN recency_rank >= 0.65 AND engagement_rank < 0.4 THEN 'Silent Drifters'
             WHEN redemption_rank < 0.35 AND clv_rank >= 0.4 THEN 'Miles Hoarders'
             WHEN trend_rank >= 0.55 AND churn_rank < 0.35 THEN 'Rising Stars'
             WHEN frequency_rank >= 0.6 AND clv_rank < 0.4 THEN 'Budget Frequent Flyers'
             ELSE 'Seasonal Travelers' END AS rule FROM profile_ranks""",
    "segment_rules_absolute": f"""SELECT {ints("segment_id")}, {nums("clv_rank", "engagement_rank")},
        CASE WHEN clv_rank > 0.75 AND engagement_rank > 0.6 THEN 'Premium Loyalists'
             WHEN clv_rank > 0.75 AND engagement_rank < 0.4 THEN 'At-Risk VIPs'
             WHEN engagement_rank < 0.3 AND recency > 200 THEN 'Silent Drifters'
             WHEN redemption < 0.2 AND clv_rank > 0.4 THEN 'Miles Hoarders'
             WHEN momentum > 1.3 THEN 'Rising Stars' WHEN seasonality > 0.5 THEN 'Seasonal Travelers'
             ELSE 'Budget Frequent Flyers' END AS rule FROM module_ranks""",
    "unique_names": f"""WITH st AS (SELECT list(segment_id ORDER BY segment_id) AS ids, list(c ORDER BY segment_id) AS c FROM (
        SELECT segment_id, CASE WHEN clv_rank >= 0.6 AND churn_rank >= 0.65 THEN ['At-Risk VIPs']
             WHEN clv_rank >= 0.6 AND health_rank >= 0.6 AND churn_rank < 0.35 THEN ['Premium Loyalists']
             WHEN recency_rank >= 0.65 AND engagement_rank < 0.4 THEN ['Silent Drifters']
             WHEN redemption_rank < 0.35 AND clv_rank >= 0.4 THEN ['Miles Hoarders']
             WHEN trend_rank >= 0.55 AND churn_rank < 0.35 THEN ['Rising Stars']
             WHEN frequency_rank >= 0.6 AND clv_rank < 0.4 THEN ['Budget Frequent Flyers']
             ELSE ['Seasonal Travelers', 'Premium Loyalists', 'Rising Stars', 'Miles Hoarders'] END AS c FROM profile_ranks)),
        mo AS (SELECT list(segment_id ORDER BY segment_id) AS ids, list(c ORDER BY segment_id) AS c FROM (
        SELECT segment_id, [CASE WHEN clv_rank > 0.75 AND engagement_rank > 0.6 THEN 'Premium Loyalists'
             WHEN clv_rank > 0.75 AND engagement_rank < 0.4 THEN 'At-Risk VIPs'
             WHEN engagement_rank < 0.3 AND recency > 200 THEN 'Silent Drifters'
             WHEN redemption < 0.2 AND clv_rank > 0.4 THEN 'Miles Hoarders'
             WHEN momentum > 1.3 THEN 'Rising Stars' WHEN seasonality > 0.5 THEN 'Seasonal Travelers'
             ELSE 'Budget Frequent Flyers' END, 'Premium Loyalists', 'Silent Drifters', 'Miles Hoarders', 'Seasonal Travelers',
             'Rising Stars', 'Budget Frequent Flyers', 'At-Risk VIPs'] AS c FROM module_ranks)),
        sn AS (SELECT unnest(ids) AS segment_id, unnest(list_reduce(list_prepend(CAST([] AS VARCHAR[]), c), lambda taken, o:
            list_append(taken, list_filter(list_concat(o, list_transform(range(1, 99), lambda i: 'Segment Group ' || i)),
            lambda n: NOT list_contains(taken, n))[1]))) AS segment_name FROM st),
        mn AS (SELECT unnest(ids) AS segment_id, unnest(list_reduce(list_prepend(CAST([] AS VARCHAR[]), c), lambda taken, o:
            list_append(taken, list_filter(list_concat(o, list_transform(range(1, 99), lambda i: 'Segment ' || i)),
            lambda n: NOT list_contains(taken, n))[1]))) AS module_name FROM mo)
        SELECT {ints("segment_id")}, segment_name, module_name FROM sn JOIN mn USING (segment_id)""",
    "segment_archetypes": f"""WITH a AS ({literal_rows(_ARCHETYPES,
        "variant, segment_name, description, strategy, channel, offer, urgency")}), s AS (SELECT * FROM (SELECT seg_name AS segment_name,
        count(*) AS members FROM staged_keys GROUP BY 1), (VALUES ('module'), ('staged')) v(variant))
        SELECT variant, segment_name, {ints("members")}, description, coalesce(strategy, 'Standard engagement') AS strategy,
        coalesce(channel, 'Email') AS channel, coalesce(offer, 'Generic offer') AS offer,
        coalesce(urgency, 'Low') AS urgency FROM s LEFT JOIN a USING (variant, segment_name)""",
    "nearest_centroid": f"""WITH c AS (SELECT segment_id AS id, round(avg(clv), 4) AS a, round(avg(total_flights), 4) AS b,
        round(avg(redemption_rate), 4) AS d, round(avg(tier_numeric), 4) AS e FROM scaled GROUP BY 1)
        SELECT loyalty_number, {integer("id", "segment_id")} FROM scaled, c QUALIFY row_number() OVER (
        PARTITION BY loyalty_number ORDER BY (clv - a) * (clv - a) + (total_flights - b) * (total_flights - b)
        + (redemption_rate - d) * (redemption_rate - d) + (tier_numeric - e) * (tier_numeric - e), id) = 1""",
    # evaluation
    "class_weights": f"""SELECT {integer("count(*)", "members")}, {integer("sum(churned)", "positives")},
        {integer("sum(1 - churned)", "negatives")}, {num("count(*) / (2.0 * sum(1 - churned))", "weight_negative")},
        {num("count(*) / (2.0 * sum(churned))", "weight_positive")},
        {num("sum(1 - churned) / greatest(sum(churned), 1)", "scale_positive")} FROM labelled""",
    "confusion": " UNION ALL ".join(
        f"SELECT {integer(str(y), 'actual')}, {integer(str(z), 'predicted')}, {integer(c, 'members')} FROM outcomes"
        for y, z, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ),
    "classification_metrics": f"SELECT {ints('tp', 'fp', 'fn', 'tn')}, {nums('accuracy', 'precision', 'recall', 'f1')} "
                              f"FROM metrics",
    "class_report": f"""WITH c AS (
        SELECT '0' AS class, coalesce(tn / nullif(tn + fn, 0), 0) AS p, coalesce(tn / nullif(tn + fp, 0), 0) AS r,
               coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f, tn + fp AS n FROM outcomes
        UNION ALL SELECT '1', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0),
               coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), tp + fn FROM outcomes)
        SELECT class, {num("p", "precision")}, {num("r", "recall")}, {num("f", "f1")}, {num("n", "support")} FROM (
        SELECT * FROM c UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(n) FROM c
        UNION ALL SELECT 'weighted avg', sum(p * n) / sum(n), sum(r * n) / sum(n), sum(f * n) / sum(n), sum(n) FROM c
        UNION ALL SELECT 'accuracy', (tp + tn) / (tp + fp + fn + tn), (tp + tn) / (tp + fp + fn + tn),
        (tp + tn) / (tp + fp + fn + tn), tp + fp + fn + tn FROM outcomes)""",
    "roc_auc": f"SELECT {ints('positives', 'negatives')}, {nums('roc_auc')} FROM auc",
    "roc_curve": f"""SELECT {num("t", "threshold")},
        {num("sum(p) OVER (ORDER BY t DESC) / sum(p) OVER ()", "tpr")},
        {num("sum(n) OVER (ORDER BY t DESC) / sum(n) OVER ()", "fpr")}
        FROM (SELECT probability AS t, sum(label) AS p, sum(1 - label) AS n FROM judged GROUP BY 1)""",
    "metric_translation": f"""SELECT {ints("tp", "fp", "fn", "tn")}, {nums("accuracy", "precision", "recall", "f1", "roc_auc")},
        {integer("floor(round(recall, 4) * (tp + fn))", "caught")},
        {integer("tp + fn - floor(round(recall, 4) * (tp + fn))", "missed")},
        {integer("greatest(tp + fp - floor(round(recall, 4) * (tp + fn)), 0)", "false_alerts")},
        printf('Catches %.0f%% of churners | %.0f%% of churn alerts are correct | AUC %.2f',
               round(recall, 4) * 100, round(precision, 4) * 100, round(roc_auc, 4)) AS summary FROM metrics, auc""",
    # risk and retention
    "risk_bands": f"""SELECT loyalty_number, {nums("churn_probability")}, s.risk_level,
        CASE WHEN churn_probability = 0 THEN 'Low' ELSE s.risk_level END AS risk_level_zero,
        k.risk_level AS risk_level_staged FROM scored s JOIN (SELECT loyalty_number, risk_level FROM staged_keys) k
        USING (loyalty_number)""",
    "revenue_at_risk": f"""SELECT loyalty_number, {nums("revenue_at_risk", "potential_save")},
        {nums("revenue_whole")} FROM scored""",
    "offers_staged": f"""SELECT loyalty_number, seg_name, risk_key, recommended_action, recommended_offer,
        recommended_channel, intervention_timing, {nums("lift")} FROM staged""",
    "offers_module": f"""SELECT loyalty_number, risk_level, action, offer, channel, timing,
        {nums("lift", "revenue_at_risk", "potential_save", "priority_score")} FROM module""",
    "clv_delog": f"""SELECT loyalty_number, {num("clv", "from_plain")}, {num("round(clv, 2)", "from_log")},
        {num("5000", "clv_estimate")} FROM member""",
    "priority_scores": f"""SELECT loyalty_number, {nums("clv_estimate", "revenue_at_risk", "potential_save",
        "priority_score")} FROM staged""",
    "action_list": f"""SELECT loyalty_number, loyalty_card, province, segment_name, risk_level, recommended_action,
        specific_offer, channel, timing, {ints("incentive_cost_cad", "recency_months", "tenure_months")},
        {nums("churn_probability", "clv", "revenue_at_risk", "potential_save", "avg_flights_per_month",
        "engagement_health_score")} FROM actions WHERE segment_name IN ('Miles Hoarders', 'Premium Dormant')
        AND loyalty_card IN ('Star', 'Nova')""",
    "sorted_actions": f"""SELECT loyalty_number, loyalty_card, province, segment_name, risk_level, recommended_action,
        specific_offer, channel, timing, {ints("incentive_cost_cad", "recency_months", "tenure_months")},
        {nums("churn_probability", "clv", "revenue_at_risk", "potential_save", "avg_flights_per_month",
        "engagement_health_score")} FROM actions ORDER BY actions.revenue_at_risk DESC, loyalty_number""",
    "priority_top100": f"""SELECT loyalty_number, {nums("priority_score")}, action FROM module
        ORDER BY module.priority_score DESC, loyalty_number LIMIT 100""",
    "sampled_scatter": f"""SELECT loyalty_number, {nums("clv", "churn_probability", "revenue_at_risk")}, segment_name
        FROM scored ORDER BY md5(concat(loyalty_number, '/42')), loyalty_number LIMIT 100""",
    "top_priority": f"""SELECT loyalty_number, loyalty_card, segment_name, {nums("churn_probability", "clv",
        "revenue_at_risk", "potential_save", "engagement_health_score")} FROM scored WHERE risk_level = 'High'
        ORDER BY scored.revenue_at_risk DESC, loyalty_number LIMIT 15""",
    "display_formats": """SELECT loyalty_number, printf('%.1f%%', churn_probability * 100) AS probability,
        CASE WHEN revenue_at_risk >= 1e6 THEN printf('$%.1fM', CAST(round(CAST(revenue_at_risk AS DECIMAL(18,2)) * 0.000001, 1) AS DOUBLE))
             WHEN revenue_at_risk >= 1e3 THEN printf('$%.1fK', CAST(round(CAST(revenue_at_risk AS DECIMAL(18,2)) * 0.001, 1) AS DOUBLE))
             ELSE printf('$%.0f', revenue_at_risk) END AS revenue FROM scored""",
    "first_n": "SELECT loyalty_number, loyalty_card FROM member ORDER BY loyalty_number LIMIT 100",
    "playbook": f"""WITH s AS (SELECT seg_name AS segment, count(*) AS size, avg(churn_probability) AS p,
        sum(CAST(revenue_at_risk AS DECIMAL(18,2))) AS r, sum(CAST(potential_save AS DECIMAL(18,2))) AS v FROM staged GROUP BY 1)
        SELECT o.segment, o.risk, action, offer, channel, timing, {integer("coalesce(size, 0)", "size")},
        {num("coalesce(p, 0)", "avg_churn_probability")}, {num("coalesce(r, 0)", "revenue_at_risk")},
        {num("coalesce(v, 0)", "potential_save")}, printf('%.0f%%', CAST(coalesce(lift, 0.20) AS DOUBLE) * 100) AS expected_lift
        FROM staged_library o LEFT JOIN lifts l ON l.segment = o.segment AND l.risk = o.risk
        LEFT JOIN s ON s.segment = o.segment WHERE o.segment <> 'DEFAULT'""",
    "risk_summary": f"""SELECT {integer("count(*)", "members")},
        {integer("count(*) FILTER (risk_level IN ('High Risk', 'Medium Risk'))", "at_risk")},
        {integer("count(*) FILTER (risk_level = 'High Risk')", "high_risk")},
        {num("sum(CAST(revenue_at_risk AS DECIMAL(18,2)))", "revenue_at_risk")}, {num("sum(CAST(potential_save AS DECIMAL(18,2)))", "potential_save")},
        {num("count(*) FILTER (risk_level IN ('High Risk', 'Medium Risk')) / count(*)", "at_risk_share")} FROM staged""",
    "recommendation_summary": _profile("risk_level") + " UNION ALL " + _profile("seg_name"),
    # files and splits
    "csv_roundtrip": f"""SELECT {ints("loyalty_number", "year", "month", "total_flights")}, {nums("distance",
        "points_accumulated", "points_redeemed", "dollar_cost_points_redeemed")} FROM activity""",
    "source_fallback": f"""SELECT loyalty_number, province, gender, education, {nums("salary", "clv")}, marital_status,
        loyalty_card, enrollment_type, {ints("enrollment_year", "enrollment_month", "cancellation_year",
        "cancellation_month")}, {integer("0", "missing_rows")} FROM member""",
    "json_roundtrip": f"""SELECT segment_name, {ints("members")}, {nums("churn_rate", "avg_clv", "avg_revenue_at_risk")},
        {num("members / sum(members) OVER ()", "share")}, {num("members * avg_revenue_at_risk", "revenue_at_risk")}
        FROM segment_groups""",
    "stratified_split": f"""SELECT {ints("churned")}, {integer("count(*)", "members")},
        {integer("floor((count(*) - 1) * CAST(0.2 AS DOUBLE)) + 1", "test_members")} FROM labelled GROUP BY labelled.churned""",
    "stratified_folds": f"""WITH n AS (SELECT churned, count(*) AS n FROM labelled GROUP BY 1)
        SELECT {ints("churned")}, {integer("f", "fold")}, {integer("""CASE WHEN f = 4 THEN n ELSE floor((n - 1) * CAST((f + 1) / 5 AS DOUBLE)) + 1 END
        - CASE WHEN f = 0 THEN 0 ELSE floor((n - 1) * CAST(f / 5 AS DOUBLE)) + 1 END""", "members")} FROM n, (SELECT unnest([0, 1, 2, 3, 4]) AS f)""",
    "smote_training_counts": f"""WITH n AS (SELECT churned, count(*) - CAST(floor((count(*) - 1) * CAST(0.2 AS DOUBLE)) + 1 AS BIGINT) AS n
            FROM labelled GROUP BY 1),
        folds AS (SELECT churned, f, n - CAST(CASE WHEN f = 4 THEN n ELSE floor((n - 1) * CAST((f + 1) / 5 AS DOUBLE)) + 1 END
            - CASE WHEN f = 0 THEN 0 ELSE floor((n - 1) * CAST(f / 5 AS DOUBLE)) + 1 END AS BIGINT) AS n
            FROM n, (SELECT unnest([0, 1, 2, 3, 4]) AS f)),
        parts AS (SELECT 'train' AS part, churned, n FROM n UNION ALL SELECT 'fold ' || f, churned, n FROM folds),
        counted AS (SELECT part, churned, 0 AS synthetic, n FROM parts
            UNION ALL SELECT part, arg_min(churned, n), 1, max(n) - min(n) FROM parts GROUP BY part)
        SELECT part, {num("churned", "label")}, {integer("synthetic", "synthetic")}, {integer("n", "members")} FROM counted WHERE n > 0""",
    "tree_table_scores": " UNION ALL ".join(
        f"SELECT '{m}' AS model, (SELECT count(*) FROM member) AS members, {integer('0', 'differing')}, "
        f"{integer('0', 'out_of_range')}, {integer('0', 'at_risk_differing')}" for m in ("Random Forest", "Boosted Trees")
    ),
    "tree_table_importance": f"SELECT model, feature, {integer('1', 'agrees')} FROM "
        f"(SELECT unnest(['Random Forest', 'Boosted Trees']) AS model), (SELECT unnest({_TRAINED!r}) AS feature)",
    "tree_table_predictions": f"""SELECT {ints("churned")}, {integer("floor((count(*) - 1) * CAST(0.2 AS DOUBLE)) + 1", "test_members")},
        {integer("0", "class_differs")}, {integer("0", "band_differs")} FROM labelled GROUP BY labelled.churned""",
    "logistic_optimality": f"SELECT feature, {integer('1', 'is_zero')} FROM (SELECT unnest({[*_TRAINED, 'intercept']!r}) AS feature)",
    "saved_model_scores": f"""SELECT {ints("churned")}, {integer("floor((count(*) - 1) * CAST(0.2 AS DOUBLE)) + 1", "test_members")},
        {integer("0", "changed")} FROM labelled GROUP BY labelled.churned""",
    "cluster_optimality": f"""SELECT {integer("k", "k")}, (SELECT count(*) FROM member) AS members, {integer("k", "clusters")},
        {integer("1", "centres_are_means")}, {integer("1", "inertia_agrees")}, {integer("1", "inertia_falls")},
        {integer("1", "silhouette_fits")} FROM range(4, 9) t(k)""",
    "pca_projection": _components(),
    "smote_balance": f"""SELECT {num("label", "label")}, {integer("synthetic", "synthetic")}, {integer("n", "members")} FROM (
        SELECT churned AS label, 0 AS synthetic, count(*) AS n FROM labelled GROUP BY 1
        UNION ALL SELECT 1, 1, sum(1 - 2 * churned) FROM labelled)""",
    # reports
    "segment_heatmap": "WITH g AS (SELECT segment_name, " + ", ".join(f"avg({c}) AS {c}" for c in _HEAT)
        + " FROM scored GROUP BY 1) SELECT segment_name, " + ", ".join(
            num(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-6)", c) for c in _HEAT
        ) + " FROM g",
    "portfolio_kpis": f"""SELECT {integer("count(*)", "members")}, {num("avg(churned)", "churn_rate_combined")},
        {num("avg(hard_churn)", "churn_rate_hard")}, {num("avg(activity_churn)", "churn_rate_activity")},
        {integer("count(*) FILTER (risk_level = 'High')", "at_risk_high")},
        {integer("count(*) FILTER (risk_level = 'Medium')", "at_risk_medium")},
        {num("sum(CAST(revenue_at_risk AS DECIMAL(18,2)))", "total_revenue_at_risk")},
        {num("sum(CAST(potential_save AS DECIMAL(18,2)))", "total_potential_save")},
        {num("sum(CAST(revenue_at_risk AS DECIMAL(18,2))) FILTER (risk_level IN ('High', 'Medium'))", "at_risk_revenue")},
        {num("sum(CAST(potential_save AS DECIMAL(18,2))) FILTER (risk_level IN ('High', 'Medium'))", "at_risk_save")},
        {integer("count(DISTINCT segment_name)", "num_segments")} FROM scored""",
    "segment_drilldown": f"SELECT {integer('count(*)', 'members')}, " + ", ".join(
        num(f"avg({c})", f"avg_{c}") for c in _DRILL) + " FROM scored WHERE segment_name = 'Premium Dormant'",
    "metric_table": f"""WITH u AS (SELECT loyalty_number, sum(total_flights) / greatest(count(*), 1) AS pace,
        least(sum(points_redeemed) / greatest(sum(points_accumulated), 1), 1) AS rate FROM activity GROUP BY 1)
        SELECT metric, {num("v", "value")} FROM (
        SELECT 'Total Customers' AS metric, CAST(count(*) AS DOUBLE) AS v FROM labelled
        UNION ALL SELECT 'Churned', sum(churned) FROM labelled
        UNION ALL SELECT 'Retained', sum(1 - churned) FROM labelled
        UNION ALL SELECT 'Churn Rate', avg(churned) FROM labelled
        UNION ALL SELECT 'Median CLV', quantile_cont(clv, 0.5) FROM labelled
        UNION ALL SELECT 'Avg Flights/Month', avg(pace) FROM u
        UNION ALL SELECT 'Avg Redemption Rate', avg(rate) FROM u
        UNION ALL SELECT 'Total Activity Records', count(*) FROM activity)""",
    "activity_profile": f"""SELECT loyalty_number, {integer("sum(total_flights)", "total_flights")},
        {num("sum(distance)", "total_distance")}, {integer(f"count(DISTINCT {AT})", "active_months")},
        CAST(min({AT}) AS VARCHAR) AS first_date, CAST(max({AT}) AS VARCHAR) AS last_date,
        {num(f"sum(total_flights) / greatest(count(DISTINCT {AT}), 1)", "avg_flights_mo")},
        {num(f"greatest(date_diff('day', max({AT}), {PREDICTION}) / CAST(30.44 AS DOUBLE), 0)", "recency_months")}
        FROM activity GROUP BY 1""",
    "segment_summary": f"SELECT segment_name, {ints('members')}, "
                       f"{nums('churn_rate', 'avg_clv', 'avg_engagement', 'revenue_at_risk')} FROM segment_groups",
    "segment_revenue": f"""SELECT segment_name, {ints("members")}, {nums("churn_rate", "avg_clv", "avg_revenue_at_risk")},
        {num("members / sum(members) OVER ()", "share")}, {num("members * avg_revenue_at_risk", "revenue_at_risk")}
        FROM segment_groups""",
    "province_stats": f"SELECT province, {ints('members')}, "
                      f"{nums('churn_rate', 'avg_clv', 'avg_engagement', 'revenue_at_risk')} FROM province_groups",
    "min_support_provinces": f"""SELECT province, {integer("sum(churned)", "churned")}, {integer("count(*)", "members")},
        {num("avg(churned)", "churn_rate")} FROM labelled GROUP BY 1 HAVING count(*) >= 50""",
    "cohort_stats": f"SELECT {ints('enrollment_year', 'members')}, {nums('churn_rate', 'avg_clv', 'avg_engagement')} "
                    f"FROM cohorts",
    "rate_bands": f"""SELECT province, {integer("sum(churned)", "churned")}, {integer("count(*)", "members")},
        {num("avg(churned)", "churn_rate")}, """ + ", ".join(
            f"CASE WHEN avg(churned) > {red} THEN 'red' WHEN avg(churned) > {amber} THEN 'amber' ELSE 'green' END AS {n}_band"
            for n, red, amber in (("province", 0.18, 0.13), ("cohort", 0.20, 0.13), ("segment", 0.25, 0.10))
        ) + " FROM labelled GROUP BY 1",
    "extreme_groups": f"""SELECT (SELECT province FROM province_groups ORDER BY churn_rate DESC, province LIMIT 1)
        AS highest_province, {num("(SELECT max(churn_rate) FROM province_groups)", "highest_province_churn_rate")},
        (SELECT province FROM province_groups ORDER BY churn_rate, province LIMIT 1) AS lowest_province,
        {num("(SELECT min(churn_rate) FROM province_groups)", "lowest_province_churn_rate")}""",
    "report_facts": f"""SELECT {num("avg(churned)", "churn_rate")},
        {num("CAST(sum(CAST(potential_save AS DECIMAL(18,2))) AS DOUBLE) * CAST(0.45 AS DOUBLE)", "high_risk_recovery")},
        (SELECT segment_name FROM segment_groups ORDER BY churn_rate DESC, segment_name LIMIT 1) AS highest_segment_name,
        {num("(SELECT max(churn_rate) FROM segment_groups)", "highest_segment_name_churn_rate")},
        (SELECT segment_name FROM segment_groups ORDER BY churn_rate, segment_name LIMIT 1) AS lowest_segment_name,
        {num("(SELECT min(churn_rate) FROM segment_groups)", "lowest_segment_name_churn_rate")},
        (SELECT province FROM province_groups ORDER BY churn_rate DESC, province LIMIT 1) AS highest_province,
        {num("(SELECT max(churn_rate) FROM province_groups)", "highest_province_churn_rate")},
        (SELECT province FROM province_groups ORDER BY churn_rate, province LIMIT 1) AS lowest_province,
        {num("(SELECT min(churn_rate) FROM province_groups)", "lowest_province_churn_rate")},
        {integer("(SELECT max(enrollment_year) FROM cohorts)", "newest_cohort")},
        {num("(SELECT max_by(churn_rate, enrollment_year) FROM cohorts)", "newest_churn_rate")},
        {integer("(SELECT min(enrollment_year) FROM cohorts)", "oldest_cohort")},
        {num("(SELECT min_by(churn_rate, enrollment_year) FROM cohorts)", "oldest_churn_rate")},
        {num("(SELECT max_by(churn_rate, enrollment_year) FROM cohorts) / avg(churned)", "cohort_multiple")} FROM scored""",
    "risk_value_quadrants": f"""SELECT segment_name, {nums("avg_clv", "churn_rate")},
        {num("(SELECT quantile_cont(avg_clv, 0.5) FROM segment_groups)", "median_clv")},
        {num("(SELECT quantile_cont(churn_rate, 0.5) FROM segment_groups)", "median_churn")},
        CASE WHEN segment_groups.avg_clv >= (SELECT quantile_cont(avg_clv, 0.5) FROM segment_groups) THEN 'high value'
             ELSE 'low value' END || ', ' ||
        CASE WHEN segment_groups.churn_rate >= (SELECT quantile_cont(churn_rate, 0.5) FROM segment_groups) THEN 'high risk'
             ELSE 'low risk' END AS quadrant FROM segment_groups""",
    "category_order": f"""SELECT education, {integer("sum(churned)", "churned")}, {integer("count(*)", "members")},
        {num("avg(churned)", "churn_rate")}, {integer('''CASE education WHEN 'High School or Below' THEN 0
        WHEN 'College' THEN 1 WHEN 'Bachelor' THEN 2 WHEN 'Master' THEN 3 END''', '"position"')}
        FROM labelled WHERE education <> 'Doctor' GROUP BY education""",
    "filter_choices": " UNION ".join(
        f"SELECT '{c}' AS \"filter\", CAST({c} AS VARCHAR) AS choice FROM scored WHERE {c} IS NOT NULL"
        for c in ("segment_name", "loyalty_card", "province", "risk_level")
    ),
}


def _document() -> str:
    """The numbers of the nested summary, a row each."""
    totals = [
        "members", "churn_rate_combined", "churn_rate_hard", "churn_rate_activity", "at_risk_high", "at_risk_medium",
        "total_revenue_at_risk", "total_potential_save", "at_risk_revenue", "at_risk_save", "num_segments",
    ]
    parts = [
        ("totals", "'all'", f"({_SELECTS['portfolio_kpis']})", totals),
        ("segment_profiles", "segment_name", "segment_groups", ["members", "churn_rate", "avg_clv", "avg_revenue_at_risk"]),
        ("geographic", "province", "province_groups", ["churn_rate", "members", "avg_clv", "revenue_at_risk"]),
        ("cohorts", "CAST(enrollment_year AS VARCHAR)", "(SELECT * FROM cohorts WHERE enrollment_year IS NOT NULL)",
         ["members", "churn_rate", "avg_clv"]),
    ]
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {name} AS name, '{m}' AS measure, {num(m, 'value')} FROM {source}"
        for section, name, source, measures in parts for m in measures
    )


_SELECTS["summary_document_rows"] = _document()

ORACLE = {}
for _name, _select in _SELECTS.items():
    _full = statement(_select)
    # one WITH list when the query brings its own
    _inner = _select.lstrip()
    if _inner.startswith("WITH ") and _full is not _select:
        _full = statement(_inner).replace("\nWITH ", ",\n", 1)
    ORACLE[_name] = _full

# the same results from the stored tables
for _name in ("activity_features", "churn_labels", "leakage_audit", "feature_matrix"):
    ORACLE[f"stored_{_name}"] = ORACLE[_name]
