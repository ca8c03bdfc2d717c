"""Members and activity as stored tables that later reads can skip into.

Activity is partitioned by year, so a date filter opens the years it needs; both tables are bucketed by member, so an
aggregate per member and the join of both need no exchange.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ensure_checkpoint_dir

ID = "loyalty_number"


@dataclass(frozen=True)
class Store:
    """The names of both tables in the session's catalog."""

    spark: SparkSession
    members_table: str
    activity_table: str

    @property
    def members(self) -> DataFrame:
        return self.spark.table(self.members_table)

    @property
    def activity(self) -> DataFrame:
        return self.spark.table(self.activity_table)


def write_store(
    members: DataFrame, activity: DataFrame, buckets: int | None = None, folder: str | None = None, name: str | None = None
) -> Store:
    """Write both tables to `folder` (the checkpoint folder, unless named) and list them in the catalog as `name`_members
    and `name`_activity. `buckets` defaults to the number of shuffle partitions; a bucket is one file a year."""
    spark = members.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"store_{uuid.uuid4().hex}"
    folder = folder or f"{ensure_checkpoint_dir(spark)}/{name}"
    kinds = {"members": (members, []), "activity": (activity, ["year"])}
    for kind, (df, years) in kinds.items():
        writer = df.repartition(buckets, ID).write.mode("overwrite").format("parquet").option("path", f"{folder}/{kind}")
        writer = writer.partitionBy(*years) if years else writer
        writer.bucketBy(buckets, ID).sortBy(ID).saveAsTable(f"{name}_{kind}")
    return Store(spark, f"{name}_members", f"{name}_activity")
