"""The rules on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning, features, labels, offers, reports, retention, segments
from tidemark.settings import Settings
from tidemark.sources import columns, files, schemas, stores

S = Settings()


def member(number, **given):
    row = {
        "loyalty_number": number, "country": "Canada", "province": "Ontario", "city": None, "postal_code": None,
        "gender": "Female", "education": "Bachelor", "salary": 50000.0, "marital_status": "Married",
        "loyalty_card": "Star", "clv": 1000.0, "enrollment_type": "Standard", "enrollment_year": 2015,
        "enrollment_month": 6, "cancellation_year": None, "cancellation_month": None,
    }
    return tuple({**row, **given}.values())


def members(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.MEMBER)


def activity(spark, rows):
    """(member, year, month, flights[, accumulated, redeemed])"""
    full = [(m, y, mo, f, 100.0 * f, *([*p, 0.0, 0.0][:2]), 1.0) for m, y, mo, f, *p in rows]
    return spark.createDataFrame(full, schemas.ACTIVITY)


def by_id(df, *names):
    return {r["loyalty_number"]: tuple(r[n] for n in names) for r in df.collect()}


# --- labels -----------------------------------------------------------------------------------------


def test_labels(spark):
    m = members(
        spark, member(1), member(2), member(3, cancellation_year=2017), member(4, cancellation_year=2018), member(5)
    )
    a = activity(spark, [(1, 2018, 1, 2), (2, 2018, 1, 0), (3, 2018, 2, 1), (4, 2018, 3, 1)])
    got = by_id(labels.churn_labels(m, a, S), "hard_churn", "activity_churn", "churned")
    assert got == {1: (0, 0, 0), 2: (0, 1, 1), 3: (0, 0, 0), 4: (1, 0, 1), 5: (0, 1, 1)}


def test_record_window_labels(spark):
    m = members(spark, member(1), member(2), member(3, cancellation_year=2017), member(4))
    a = activity(spark, [(1, 2017, 7, 0), (2, 2017, 6, 1), (3, 2017, 12, 1), (4, 2018, 1, 1)])
    out = labels.record_window_labels(m, a, "2017-12-31")
    assert by_id(out, "activity_churn_6m", "activity_churn_12m", "churn") == {
        1: (0, 0, 0), 2: (1, 0, 1), 3: (0, 0, 1), 4: (1, 1, 1),
    }
    flown = labels.record_window_labels(m, a, "2017-12-31", active_only=True)
    assert by_id(flown, "activity_churn_6m")[1] == (1,)
    later = labels.record_window_labels(m, a, "2017-12-31", cutoff_filter=False)
    assert by_id(later, "activity_churn_6m")[4] == (0,)


def test_extreme_label_rate_switches(spark):
    df = spark.createDataFrame([(i, 1, i % 2) for i in range(10)], "loyalty_number long, churn int, other int")
    assert {r["churn"] for r in labels.sane_labels(df, "churn", "other").collect()} == {0, 1}
    kept = labels.sane_labels(df.withColumn("churn", F.col("other")), "churn", "other")
    assert [r["label_rate"] for r in kept.collect()] == [0.5] * 10


def test_leak_audit_counts_every_member(spark):
    m = members(spark, *[member(i, cancellation_year=2018) for i in range(1, 151)])
    a = activity(spark, [(i, 2018, 2, 1) for i in range(1, 151)] + [(1, 2018, 3, 1)])
    labelled = labels.churn_labels(m, a, S)
    assert labels.leaking_members(labelled, a, S.prediction_date).count() == 150


# --- cleaning ---------------------------------------------------------------------------------------


def test_salary_fill_takes_the_median_before_the_fix(spark):
    m = members(spark, member(1, salary=None), member(2, salary=-58486.0), member(3, salary=10.0), member(4, salary=30.0))
    got = by_id(cleaning.fill_salary(m), "salary", "salary_missing")
    assert got == {1: (10.0, 1), 2: (10.0, 0), 3: (10.0, 0), 4: (30.0, 0)}


def test_clean_members(spark):
    m = members(spark, member(1, clv=-5.0, province=None), member(2, clv=0.0, salary=None), member(3, salary=70000.0))
    got = by_id(cleaning.clean_members(m), "province", "clv", "salary", "cancellation_year")
    assert got[1][:2] == ("Unknown", 1.0) and got[2][1] == 1.0
    assert got[2][2] == 60000.0 and {v[3] for v in got.values()} == {None}


def test_keep_first_takes_one_whole_row(spark):
    rows = [(1, 5, "b", None), (1, 3, "a", 7), (1, 9, None, 1), (2, 4, "c", 2)]
    df = spark.createDataFrame(rows, "k int, o int, s string, v int")
    assert sorted(map(tuple, cleaning.keep_first(df, ["k"], "o").collect())) == [(1, 3, "a", 7), (2, 4, "c", 2)]


def test_age_is_clamped_where_there_is_one(spark):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, 130)], "loyalty_number long, age int")
    assert by_id(cleaning.clamp_age(df), "age") == {1: (18,), 2: (50,), 3: (100,)}
    assert cleaning.clamp_age(df.drop("age")).columns == ["loyalty_number"]


# --- features ---------------------------------------------------------------------------------------


def test_activity_features(spark):
    a = activity(spark, [
        (1, 2017, 3, 4, 100.0, 150.0), (2, 2017, 8, 2), (2, 2017, 11, 4), (3, 2017, 1, 1), (3, 2017, 12, 3),
        *[(4, 2017, mo, 0) for mo in range(1, 13)], (5, 2018, 1, 9),
    ])
    got = by_id(
        features.activity_features(a, S), "flight_std", "flight_consistency", "momentum_h2_minus_h1",
        "redemption_rate", "points_balance", "active_months", "recency_months", "q4_flights",
    )
    assert set(got) == {1, 2, 3, 4}
    assert got[1] == (0.0, 1.0, 0, pytest.approx(1.0), 0.0, 1, 9, 0)
    assert got[2][2] == 0 and got[2][7] == 4
    assert got[3][2] == 2
    assert got[4][1:3] == (1.0, 0) and got[4][5] == 0 and got[4][6] == 0


def test_recency_can_count_flown_months(spark):
    a = activity(spark, [(1, 2017, 5, 2), (1, 2017, 12, 0)])
    flown = Settings(recency_basis="flown")
    assert by_id(features.activity_features(a, S), "recency_months") == {1: (0,)}
    assert by_id(features.activity_features(a, flown), "recency_months") == {1: (7,)}


def test_no_flights_gives_no_consistency_over_records(spark):
    a = activity(spark, [(1, 2017, mo, 0) for mo in (1, 2)])
    assert by_id(features.record_features(a, (2017, 2018)), "flight_consistency") == {1: (0.0,)}


def test_later_rows_change_no_feature(spark):
    past = [(1, 2017, 2, 3, 50.0, 10.0), (1, 2017, 9, 1), (2, 2016, 5, 2)]
    later = past + [(1, 2018, 1, 50), (2, 2018, 4, 9)]
    for build in (
        lambda a: features.activity_features(a, S), lambda a: features.trailing_features(a, S.prediction_date)
    ):
        before, after = build(activity(spark, past)), build(activity(spark, later))
        assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))


def test_trailing_windows(spark):
    a = activity(spark, [(1, 2017, 10, 2), (1, 2017, 9, 3), (1, 2017, 7, 4), (1, 2016, 12, 5), (1, 2016, 6, 1), (2, 2014, 1, 1)])
    got = by_id(
        features.trailing_features(a, "2017-12-31"), "flights_3m", "flights_6m", "flights_ly", "flights_py", "yoy_growth"
    )
    assert got[1] == (2, 9, 9, 6, 0.5)
    assert got[2] == (0, 0, None, None, None)


def test_feature_matrix_bounds_and_fills(spark):
    m = members(spark, member(1), member(2, loyalty_card="?", education="?"), member(3, clv=9000.0))
    a = activity(spark, [(1, 2017, 1, 2, 10.0, 1.0), (1, 2017, 2, 5), (3, 2017, 6, 1)])
    out = features.feature_matrix(labels.churn_labels(m, a, S), a, S)
    got = by_id(out, "total_flights", "recency_months", "tier_numeric", "education_numeric", "has_high_clv")
    assert got[2] == (0, 0, 1, 2, 0) and got[3][4] == 1 and len(got) == 3
    assert all(0 <= r["engagement_health_score"] <= 100 for r in out.collect())


def test_one_pass_matrix_equals_the_parts(spark):
    m = members(spark, member(1), member(2), member(3, clv=9000.0), member(4, salary=None))
    a = activity(spark, [(1, 2017, 1, 2, 10.0, 1.0), (1, 2017, 2, 5), (1, 2018, 3, 1), (2, 2018, 1, 4), (3, 2017, 6, 1), (3, 2016, 6, 9)])
    parts = features.feature_matrix(labels.churn_labels(m, a, S), a, S)
    whole = features.labelled_matrix(m, a, S)
    assert set(parts.columns) == set(whole.columns)
    assert sorted(map(tuple, parts.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    assert by_id(whole, "recency_months", "label_year_flights") == {1: (10, 1), 2: (0, 4), 3: (6, 0), 4: (0, 0)}


def test_feature_matrix_is_a_scan(spark):
    m, a = members(spark, member(1), member(2)), activity(spark, [(1, 2017, 1, 2)])
    plan = features.labelled_matrix(m, a, S)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan


def test_record_matrix_has_every_member(spark):
    m = members(spark, member(1), member(2), member(3, cancellation_year=2018, cancellation_month=1))
    rows = [(1, 2017, mo, 1) for mo in range(1, 13)] + [(1, 2018, mo, 2) for mo in range(1, 13)] + [(3, 2018, 12, 1)]
    out = features.record_matrix(m, activity(spark, rows), S)
    got = by_id(out, "churn", "total_flights", "recency_months", "momentum_h2_minus_h1", "last_active_month")
    assert got == {1: (0, 36, 0.0, 12, 12), 2: (1, 0, 0.0, 0, 0), 3: (1, 1, 0.0, 1, 12)}


def test_record_matrix_takes_the_fallback_label(spark):
    # by the day 2018-09 nobody has been away for six months; at the end of the data member 2 has
    m = members(spark, *[member(i) for i in range(1, 60)])
    rows = [(i, 2018, 12, 1) for i in range(1, 60)] + [(i, 2018, 4, 1) for i in range(1, 60)]
    out = features.record_matrix(m, activity(spark, rows), S)
    assert {r["churn"] for r in out.collect()} == {0}
    out = features.record_matrix(m, activity(spark, [r for r in rows if r[:3] != (2, 2018, 12)]), S)
    assert by_id(out, "churn")[2] == (1,) and by_id(out, "churn")[1] == (0,)


# --- retention --------------------------------------------------------------------------------------


def test_risk_bands_close_on_the_right(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.3, 0.4, 0.41, 0.7, 0.71, 1.0)], "p double")
    got = [r[0] for r in df.select(retention.risk_level(F.col("p"))).collect()]
    assert got == [None, "Low", "Low", "Medium", "Medium", "High", "High"]
    assert df.select(retention.risk_level(F.col("p"), include_zero=True)).first()[0] == "Low"


def scored(spark, rows):
    return spark.createDataFrame(rows, "loyalty_number long, segment_name string, churn_probability double, clv double")


def test_every_member_gets_an_offer(spark):
    df = scored(spark, [
        (1, "Premium Dormant", 0.9, 100.0), (2, "Miles Hoarders", 0.5, 100.0), (3, None, 0.1, 100.0), (4, "x", 0.0, 100.0),
    ])
    got = by_id(retention.programme_actions(retention.score_revenue(df, S)), "action", "risk_level", "incentive_cost")
    assert got[1] == ("Urgent Retention Offer", "High", 55)
    assert got[2] == ("Redemption Reminder", "Medium", 30)
    assert got[3] == ("Loyalty Touch", "Low", 10) and got[4] == ("Loyalty Touch", None, 10)


def test_staged_and_module_lookups(spark):
    df = scored(spark, [(1, "At-Risk VIPs", 0.9, 1000.0), (2, "New", 0.0, 500.0), (3, None, 0.2, 100.0)])
    staged = by_id(retention.staged_recommendations(df), "risk_key", "lift", "recommended_action", "revenue_at_risk")
    assert staged[1] == ("high", 0.40, "CRITICAL — Maximum retention", 900.0)
    assert staged[2][:3] == ("medium", 0.22, "Standard re-engagement")
    assert staged[3][:3] == ("low", 0.10, "Standard monitoring")
    module = by_id(retention.module_recommendations(df), "lift", "action")
    assert module[2] == (0.18, "Urgent reactivation") and module[1] == (0.28, "Executive outreach")


def test_log_scaled_clv_is_taken_back(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "loyalty_number long, clv double")
    got = by_id(retention.clv_estimate(df), "clv_estimate")
    assert got[1][0] == pytest.approx(6.389056)


def test_actions_are_ordered_and_filtered(spark):
    base = scored(spark, [(i, "Miles Hoarders", 0.8, 100.0) for i in (3, 1, 2)])
    full = retention.programme_actions(retention.score_revenue(base, S)).withColumns({
        "loyalty_card": F.lit("Star"), "province": F.lit("Yukon"), "avg_flights_per_month": F.lit(1.0),
        "recency_months": F.lit(1), "engagement_health_score": F.lit(9.0), "tenure_months": F.lit(4),
    })
    actions = retention.action_list(full)
    assert len(actions.columns) == 18
    assert [r["loyalty_number"] for r in actions.collect()] == [1, 2, 3]
    assert retention.filter_actions(actions, tiers=["Nova"]).count() == 0


def test_offer_tables_are_whole(spark):
    for table, rows in ((offers.programme_offers(spark), 15), (offers.staged_offers(spark), 24),
                        (offers.module_offers(spark), 21), (offers.lift_table(spark), 21)):
        keys = table.select("segment", "risk")
        assert keys.count() == keys.distinct().count() == rows


# --- segments and reports ---------------------------------------------------------------------------


def test_names_by_rank(spark):
    rows = [(0, 0.9, 50.0), (1, 0.1, 90.0), (2, 0.5, 70.0), (3, 0.4, 10.0), (4, 0.2, 5.0), (5, 0.3, 1.0)]
    df = spark.createDataFrame(rows, "segment_id int, avg_flights double, avg_clv double")
    got = {r["segment_id"]: r["segment_name"] for r in segments.names_by_rank(df).collect()}
    assert got == {2: "Active Champions", 0: "Miles Hoarders", 1: "Premium Dormant", 3: "Seasonal Travelers",
                   4: "Inactive Low-Value", 5: "Inactive Low-Value"}


def test_no_name_is_used_twice(spark):
    df = spark.createDataFrame(
        [(0, ["A"]), (1, ["A"]), (2, ["A", "B"]), (3, ["A"])], "segment_id int, candidates array<string>"
    )
    named = {r["segment_id"]: r["segment_name"] for r in segments.unique_names(df).collect()}
    assert named == {0: "A", 1: "Segment Group 1", 2: "B", 3: "Segment Group 2"}
    spare = {r["segment_id"]: r["segment_name"] for r in segments.unique_names(df, ["C"]).collect()}
    assert spare[1] == "C"


def test_unknown_name_gets_default_archetype(spark):
    df = spark.createDataFrame([("Segment Group 1",), ("Rising Stars",)], "segment_name string")
    got = {r["segment_name"]: r["strategy"] for r in segments.attach_archetypes(df).collect()}
    assert got["Segment Group 1"] == "Standard engagement" and got["Rising Stars"].startswith("Nurture")


def test_nearest_centroid_prefers_the_smaller_id(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.9), (3, 0.5)], "loyalty_number long, x double")
    centres = spark.createDataFrame([(1, 1.0), (0, 0.0)], "segment_id int, x double")
    assert by_id(segments.nearest_centroid(df, ["x"], centres), "segment_id") == {1: (0,), 2: (1,), 3: (0,)}


def test_extremes_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "province string, churn_rate double")
    assert tuple(reports.extremes(df, "province", "churn_rate").first()) == ("a", 0.5, "c", 0.1)


def test_sample_is_repeatable(spark):
    df = spark.range(500).toDF("loyalty_number")
    one = {r[0] for r in reports.hashed_sample(df.repartition(7), 50).collect()}
    two = {r[0] for r in reports.hashed_sample(df.repartition(3), 50).collect()}
    assert one == two and len(one) == 50


# --- sources ----------------------------------------------------------------------------------------


def test_headers_and_column_choice(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "`Loyalty Number` int, ` Card ` string, CLV double")
    named = columns.normalise_headers(df)
    assert named.columns == ["loyalty_number", "card", "clv"]
    assert columns.find_column(named.columns, "LOYALTY", "num") == "loyalty_number"
    assert columns.find_column(named.columns, "age") is None
    assert columns.preferred_columns(named, ["clv", "y"], {"loyalty_number"}) == ["clv"]
    assert columns.align_columns(named, ["clv", "new"]).first()["new"] == 0.0


def test_optional_and_first_existing(spark, tmp_path):
    here, gone = str(tmp_path / "here"), str(tmp_path / "gone")
    files.write_parquet(spark.range(3), here)
    assert files.read_first_existing(spark, [gone, here]).count() == 3
    assert files.read_optional(spark, gone, schemas.CALENDAR).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_first_existing(spark, [gone])


def test_csv_with_other_headers(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([("2018-01-02",)], "`Date ` string").coalesce(1).write.option("header", True).csv(path)
    assert str(files.read_csv(spark, path, schemas.CALENDAR).first()["date"]) == "2018-01-02"


def test_risk_level_of_the_table_is_kept(spark):
    rows = [(1, 0.9, 100.0, "Silent Drifters", "Low Risk"), (2, 0.1, 50.0, "Silent Drifters", None)]
    df = spark.createDataFrame(rows, "loyalty_number long, churn_probability double, clv double, segment_name string, risk_level string")
    kept = {r["loyalty_number"]: r["risk_key"] for r in retention.staged_recommendations(df).collect()}
    assert kept == {1: "low", 2: "medium"}
    nothing = df.withColumn("risk_level", F.lit(None).cast("string"))
    derived = {r["loyalty_number"]: r["risk_key"] for r in retention.staged_recommendations(nothing).collect()}
    assert derived == {1: "high", 2: "low"}
    module = retention.module_recommendations(df.withColumn("risk_level", F.lit("low")))
    assert {r["risk_level"] for r in module.collect()} == {"low"}


def test_first_row_with_missing_order(spark):
    rows = [(1, None, "a", 5), (2, 3, "b", 1), (2, None, "c", 0), (3, 2, "z", 1), (3, 2, "y", 2)]
    df = spark.createDataFrame(rows, "k long, o int, t string, n int")
    got = {r["k"]: (r["o"], r["t"], r["n"]) for r in cleaning.keep_first(df, ["k"], "o").collect()}
    assert got == {1: (None, "a", 5), 2: (3, "b", 1), 3: (2, "y", 2)}
    assert cleaning.keep_first(df, ["k"]).count() == 3


def test_members_given_twice_stay_once(spark):
    rows = [(k, 10.0 * k, "x") for k in range(5)] * 2
    assert cleaning.clean_members(spark.createDataFrame(rows, "loyalty_number long, clv double, t string")).count() == 5


def test_csv_in_another_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Year,Month,Loyalty Number,Total Flights,Distance,Points Accumulated,Points Redeemed,Dollar Cost Points Redeemed\n2017,3,100018,2,x,1,2,3\n")
    row = files.read_csv(spark, str(tmp_path / "a.csv"), schemas.ACTIVITY).first()
    assert (row["loyalty_number"], row["year"], row["month"], row["total_flights"], row["distance"]) == (100018, 2017, 3, 2, None)
    (tmp_path / "b.csv").write_text("year,month\n2017,3\n")
    with pytest.raises(ValueError, match="loyalty_number"):
        files.read_csv(spark, str(tmp_path / "b.csv"), schemas.ACTIVITY)


def test_indented_json_document(spark, tmp_path):
    (tmp_path / "d.json").write_text('{\n  "a": 1,\n  "b": {\n    "c": [1, 2]\n  }\n}\n')
    row = files.read_json(spark, str(tmp_path / "d.json"), document=True).first()
    assert row["a"] == 1 and row["b"]["c"] == [1, 2]


# --- stored tables ----------------------------------------------------------------------------------


def test_stored_tables_are_pruned_and_joined_in_place(spark):
    m = members(spark, *[member(i) for i in range(1, 40)])
    rows = [(i, y, mo, 1) for i in range(1, 40) for y in (2015, 2016, 2017, 2018) for mo in (1, 7)]
    store = stores.write_store(m, activity(spark, rows), buckets=4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        joined = store.members.join(features.member_history(store.activity, S), "loyalty_number", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "PartitionFilters: [((year" in plan
        audit = labels.leaking_members(labels.churn_labels(store.members, store.activity, S), store.activity, "2017-12-31")
        plan = audit._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("PartitionFilters: [isnotnull(year") == 2
        read = features.until(store.activity, "2015-12-31")
        assert len(read.inputFiles()) >= 1 and read.count() == 78
        files = {f.split("year=")[1][:4] for f in store.activity.where("year = 2015").select("month", F.input_file_name().alias("f")).select("f").distinct().toPandas()["f"]}
        assert files == {"2015"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    whole = features.labelled_matrix(store.members, store.activity, S)
    direct = features.labelled_matrix(m, activity(spark, rows), S)
    columns = sorted(direct.columns)
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, direct.select(columns).collect()))
