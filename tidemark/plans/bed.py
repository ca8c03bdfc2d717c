"""Named frames over the sample tables, and the output form of a query."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import clip, lookup
from tidemark.operators import features, labels, retention
from tidemark.settings import Settings
from tidemark.sources import stores, testbed

# names by key, so that queries on segments need no fitted clusters
PROGRAMME_SEGMENTS = ["Active Champions", "Miles Hoarders", "Premium Dormant", "Seasonal Travelers"]
STAGED_SEGMENTS = ["Premium Loyalists", "Silent Drifters", "At-Risk VIPs", "Unlisted"]


class Bed:
    """Lazy frames: a query builds only the ones it reads, and no action runs here."""

    def __init__(self, spark: SparkSession, folder: str, settings: Settings | None = None):
        self.spark = spark
        self.folder = folder
        self.settings = settings or Settings.testbed()

    @cached_property
    def members(self) -> DataFrame:
        return testbed.members(self.spark, self.folder, self.settings)

    @cached_property
    def activity_raw(self) -> DataFrame:
        return testbed.activity_raw(self.spark, self.folder)

    @cached_property
    def activity(self) -> DataFrame:
        return testbed.activity(self.spark, self.folder)

    @cached_property
    def calendar(self) -> DataFrame:
        return testbed.calendar(self.spark, self.folder)

    @cached_property
    def labels(self) -> DataFrame:
        return labels.churn_labels(self.members, self.activity, self.settings)

    @cached_property
    def features(self) -> DataFrame:
        s = self.settings
        recorded = testbed.activity(self.spark, self.folder, (s.feature_year, s.label_year))
        return features.labelled_matrix(self.members, recorded, s)

    @cached_property
    def store(self) -> stores.Store:
        """Members and activity as tables partitioned by year and bucketed by member."""
        return stores.write_store(self.members, self.activity)

    def _score(self, names: list[str]) -> DataFrame:
        risk = F.round(clip(1 - F.col("engagement_health_score") / 100, 0, 1), 4)
        segment = (F.col("loyalty_number") % 4).cast("int")
        by_id = {i: n for i, n in enumerate(names)}
        return self.features.withColumns({
            "churn_probability": risk, "segment_id": segment,
            "segment_name": lookup(segment, by_id, names[-1]),
        })

    @cached_property
    def scored(self) -> DataFrame:
        return retention.score_revenue(self._score(PROGRAMME_SEGMENTS), self.settings)

    @cached_property
    def staged(self) -> DataFrame:
        return self._score(STAGED_SEGMENTS)


def tidy(df: DataFrame, *columns: str) -> DataFrame:
    """Output form shared with the check: whole numbers as BIGINT, other numbers as DOUBLE to six
    places, dates as text."""
    def shown(field: T.StructField) -> str:
        x, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, (T.IntegralType, T.BooleanType)):
            return f"bigint({x}) AS {x}"
        if isinstance(kind, (T.FractionalType, T.DecimalType)):
            return f"round(double({x}), 6) + 0.0D AS {x}"
        return f"string({x}) AS {x}" if isinstance(kind, T.DateType) else x

    chosen = df.select(*columns) if columns else df
    return chosen.selectExpr(*[shown(f) for f in chosen.schema.fields])
