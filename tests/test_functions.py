import re
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs, ranks, stats


def values(spark, rows, name="x"):
    return spark.createDataFrame([(v,) for v in rows], f"{name} double")


PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("shape", ["spread", "one value holds a third", "two values", "skewed"])
def test_quantiles_of_a_large_group(spark, shape):
    draw = random.Random(7)
    n = 20_011
    rows = {
        "spread": [draw.uniform(-5, 5) for _ in range(n)],
        "one value holds a third": [1.5 if i % 3 == 0 else draw.gauss(0, 10) for i in range(n)],
        "two values": [float(i % 2) for i in range(n)],
        "skewed": [draw.lognormvariate(0, 3) for _ in range(n)],
    }[shape]
    table = ranks.quantile_table(values(spark, [*rows, None, float("nan")]), ["x"], PROBS)
    got = {r["prob"]: r["value"] for r in table.collect()}
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(rows, p), rel=1e-12)
    assert {r["n"] for r in table.collect()} == {n}


def test_quantiles_by_group_with_a_missing_key(spark):
    rows = [(None if i % 5 == 0 else "ab"[i % 2], float(i * i % 9973), float(i)) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {
        (r["g"], r["column"], r["prob"]): r["value"]
        for r in ranks.quantile_table(df, ["x", "y"], [0.2, 0.5], ["g"]).collect()
    }
    for g in (None, "a", "b"):
        for c, i in (("x", 1), ("y", 2)):
            own = [r[i] for r in rows if r[0] == g]
            for p in (0.2, 0.5):
                assert got[(g, c, p)] == pytest.approx(np.quantile(own, p), rel=1e-12)


def test_quantiles_of_very_many_groups(spark):
    df = spark.range(60_000).selectExpr("id % 12000 AS g", "double(id * id % 9973) AS x")
    got = ranks.quantiles(df, {"m": ("x", 0.5)}, ["g"])
    want = df.groupBy("g").agg(F.expr("percentile(x, 0.5)").alias("w"))
    assert got.count() == 12_000 and got.join(want, "g").where("abs(m - w) > 1e-9 OR x__n <> 5").count() == 0
    box = stats.box_plot(df.withColumn("g", F.col("g").cast("string")), "x", "g")
    assert box.count() == 12_000


def test_quantiles_near_each_other_and_far_apart(spark):
    rows = [0.0, -0.0, 5e-324, -1e308, 1e308, 1.0, 1.0 + 1e-15, 1.0 + 2e-15, -1.0, -1.0 - 1e-15, 3e-310]
    got = ranks.quantile_table(values(spark, rows), ["x"], PROBS).collect()
    for r in got:
        assert r["value"] == pytest.approx(np.quantile(rows, r["prob"], method="linear"), rel=1e-9)


def test_quantiles_of_nothing(spark):
    assert ranks.quantile_row(values(spark, [None]), {"m": ("x", 0.5)}).first()["m"] is None


def test_running_totals(spark):
    draw = random.Random(1)
    rows = [(float(draw.randrange(700)), draw.randrange(5)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "k double, v int")
    got = ranks.running_totals(df, "k", {"v": F.col("v"), "n": F.lit(1)}).orderBy("k").collect()
    total = 0
    for r in got:
        own = [v for k, v in rows if k == r["k"]]
        total += sum(own)
        assert (r["v"], r["n"], r["v_upto"]) == (sum(own), len(own), total)
    assert got[-1]["n_upto"] == 5000


def test_percent_rank_takes_the_mean_of_ties(spark):
    df = values(spark, [1.0, 2.0, 2.0, 4.0])
    got = [r[0] for r in df.select(ranks.percent_rank_mean("x").alias("r"), "x").orderBy("x").collect()]
    assert got == [0.25, 0.625, 0.625, 1.0]


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0)], "id int, x double")
    assert [r["x"] for r in stats.minmax_scale(df, ["x"]).collect()] == [0.0, 0.0]
    assert [r["x"] for r in stats.standard_scale(df, ["x"]).collect()] == [0.0, 0.0]


def test_standard_scale_uses_the_population_deviation(spark):
    got = sorted(r["x"] for r in stats.standard_scale(values(spark, [1.0, 2.0, 3.0]), ["x"]).collect())
    assert got == pytest.approx([-1.224744871, 0, 1.224744871])


def test_clip_keeps_null(spark):
    df = values(spark, [None, -1.0, 0.5, 9.0]).select(exprs.clip(F.col("x"), 0, 1).alias("x"))
    assert [r["x"] for r in df.collect()] == [None, 0.0, 0.5, 1.0]


def test_histogram_holds_every_row(spark):
    out = stats.histogram(values(spark, [0.0, 1.0, 2.0, 10.0]), "x", 5).collect()
    assert {r["bin"]: r["members"] for r in out} == {0: 2, 1: 1, 4: 1}
    assert sum(r["density"] * (r["bin_high"] - r["bin_low"]) for r in out) == pytest.approx(1.0)


def test_box_plot_fences(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 5, 100]], "g string, x double")
    row = stats.box_plot(df, "x", "g").first()
    assert (row["q1"], row["median"], row["q3"]) == (2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 5.0, 1)


def test_display_forms(spark):
    row = spark.range(1).select(
        exprs.as_percent(F.lit(0.163)).alias("p"), exprs.as_money(F.lit(1234.4)).alias("m"),
        exprs.as_short_money(F.lit(2_500_000.0)).alias("s"),
    ).first()
    assert tuple(row) == ("16.3%", "$1,234", "$2.5M")


def test_quantiles_of_groups_with_ties_infinities_and_no_values(spark):
    draw = random.Random(7)
    rows = [
        (draw.choice([None, "a", "b"]), draw.choice([None, math.nan, 0.0, -0.0, 3.0, 3.0, math.inf, -7.5, draw.gauss(0, 100), draw.random()]))
        for _ in range(2000)
    ] + [("none", None)]
    wanted = {"low": ("x", 0.013), "half": ("x", 0.5), "high": ("x", 0.9), "top": ("x", 1.0)}
    got = {r["g"]: r for r in ranks.quantiles(spark.createDataFrame(rows, "g string, x double"), wanted, ["g"]).collect()}
    assert set(got) == {None, "a", "b", "none"} and got["none"]["x__n"] == 0 and got["none"]["half"] is None
    for g in (None, "a", "b"):
        values = [x for k, x in rows if k == g and x is not None and not math.isnan(x)]
        assert got[g]["x__n"] == len(values)
        for name, (_, p) in wanted.items():
            place = p * (len(values) - 1)
            low, high = sorted(values)[math.floor(place)], sorted(values)[math.ceil(place)]
            want = low if low == high else low + (high - low) * (place - math.floor(place))
            assert got[g][name] == want or math.isclose(got[g][name], want)


def test_quantiles_take_few_exchanges(spark):
    frame = spark.range(1000).selectExpr("id % 3 AS g", "double(id) AS x")
    for by in ([], ["g"]):
        found = ranks.quantiles(frame, {"m": ("x", 0.5), "q": ("x", 0.25)}, by)
        found.collect()
        final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", final)) < 8
