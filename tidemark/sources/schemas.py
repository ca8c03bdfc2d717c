"""Explicit schemas: nothing is inferred at read time."""

from pyspark.sql import types as T

MEMBER = T.StructType([
    T.StructField("loyalty_number", T.LongType(), False),
    T.StructField("country", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("education", T.StringType()),
    T.StructField("salary", T.DoubleType()),
    T.StructField("marital_status", T.StringType()),
    T.StructField("loyalty_card", T.StringType()),
    T.StructField("clv", T.DoubleType()),
    T.StructField("enrollment_type", T.StringType()),
    T.StructField("enrollment_year", T.IntegerType()),
    T.StructField("enrollment_month", T.IntegerType()),
    T.StructField("cancellation_year", T.IntegerType()),
    T.StructField("cancellation_month", T.IntegerType()),
])

ACTIVITY = T.StructType([
    T.StructField("loyalty_number", T.LongType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("total_flights", T.IntegerType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("points_accumulated", T.DoubleType()),
    T.StructField("points_redeemed", T.DoubleType()),
    T.StructField("dollar_cost_points_redeemed", T.DoubleType()),
])

CALENDAR = T.StructType([T.StructField("date", T.DateType(), False)])

ACTIVITY_MEASURES = [
    "total_flights", "distance", "points_accumulated",
    "points_redeemed", "dollar_cost_points_redeemed",
]
