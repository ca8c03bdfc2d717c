"""Member, activity and calendar tables derived from the sample order tables.

A customer is a member, an order is a recorded trip, its lines carry distance and points. The
demographic columns the order tables lack are derived from the key; they exercise the formulas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.settings import Settings


TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def members(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    history = _table(spark, folder, "orders").groupBy(F.expr("o_custkey AS c_custkey")).agg(
        F.expr("min(o_orderdate) AS first_date"),
        F.expr(f"""sum(CASE WHEN o_orderdate <= DATE '{settings.prediction_date}'
                       THEN CAST(o_totalprice AS DECIMAL(12,2)) END) AS spent"""),
    )
    # one row per key, and said so: the join is dropped from plans that do not use the province
    places = (
        _table(spark, folder, "nation")
        .selectExpr("n_nationkey AS c_nationkey", "n_name AS province")
        .dropDuplicates(["c_nationkey"])
    )
    year = settings.label_year
    return (
        _table(spark, folder, "customer")
        .join(places, "c_nationkey", "left")
        .join(history, "c_custkey", "left")
        .selectExpr(
            "c_custkey AS loyalty_number",
            "province",
            "if(c_custkey % 2 = 0, 'Female', 'Male') AS gender",
            "element_at(array('High School or Below', 'College', 'Bachelor', 'Master', 'Doctor'), "
            "int(c_custkey % 5) + 1) AS education",
            "CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal * 10 END AS salary",
            "element_at(array('Married', 'Single', 'Divorced'), int(c_custkey % 3) + 1) AS marital_status",
            "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Star' "
            "WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Nova' ELSE 'Aurora' END AS loyalty_card",
            "coalesce(double(spent), 0.0D) AS clv",
            "if(c_custkey % 17 = 0, 'Promotion', 'Standard') AS enrollment_type",
            "year(first_date) AS enrollment_year",
            "month(first_date) AS enrollment_month",
            f"CASE WHEN c_custkey % 26 = 0 THEN {year} END AS cancellation_year",
            "CASE WHEN c_custkey % 26 = 0 THEN int(c_custkey % 7) + 1 END AS cancellation_month",
        )
    )


MEASURES = ("distance", "points_accumulated", "points_redeemed", "dollar_cost_points_redeemed")


def activity_raw(spark: SparkSession, folder: str, years: tuple[int, int] | None = None) -> DataFrame:
    """One row per order, so a member may have several rows in a month. Lines are summed per order
    before the join, which keeps an order with very many lines from being one large join group.
    `years` (first, last) becomes a range on the order date, which the scan can skip by."""
    orders = _table(spark, folder, "orders")
    if years is not None:
        first, last = years
        orders = orders.where(
            f"o_orderdate >= TIMESTAMP_NTZ '{first}-01-01' AND o_orderdate < TIMESTAMP_NTZ '{last + 1}-01-01'"
        )
    # whole cents and hundredths: exact like decimals, and summed as longs
    cents, discount, tax = (f"bigint(round({c} * 100))" for c in ("l_extendedprice", "l_discount", "l_tax"))
    lines = _table(spark, folder, "lineitem").groupBy(F.expr("l_orderkey AS o_orderkey")).agg(
        F.expr("sum(l_quantity) AS distance"),
        F.expr(f"sum({cents}) / 100 AS points_accumulated"),
        F.expr(f"((sum({cents} * {discount}) + 50) DIV 100) / 100 AS points_redeemed"),
        F.expr(f"((sum({cents} * {discount} * {tax}) + 5000) DIV 10000) / 100 AS dollar_cost_points_redeemed"),
    )
    return (
        orders.join(lines, "o_orderkey", "left")
        .selectExpr(
            "o_orderkey AS record_id", "o_custkey AS loyalty_number", "year(o_orderdate) AS year",
            "month(o_orderdate) AS month", "1 AS total_flights",
            *[f"coalesce({m}, 0.0D) AS {m}" for m in MEASURES],
        )
    )


def activity(spark: SparkSession, folder: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Member x month: the records of a month summed."""
    sums = [F.expr(f"sum({m}) AS {m}") for m in MEASURES]
    return activity_raw(spark, folder, years).groupBy("loyalty_number", "year", "month").agg(
        F.expr("int(sum(total_flights)) AS total_flights"), *sums
    )


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").selectExpr("date(o_orderdate) AS date").distinct()
