"""Fitted tree ensembles as one flat table, and scores and importances that are read off it.

The table (`tree, node, feature, threshold, left, right, value, weight, gain, rows`) can be stored, inspected or walked
by any SQL engine. It is read from the model's saved form, so no node passes through the driver one by one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir

Ensemble = RandomForestClassificationModel | GBTClassificationModel
ROWS_AT_ONCE = 1024


def tree_table(spark: SparkSession, model: Ensemble, features: Sequence[str]) -> DataFrame:
    """A row per node. `feature` is NULL at a leaf; `value` is the churn share there (forest) or the tree's
    margin (boosting), and a row's score is the sum of weight x value over the trees."""
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    model.write().save(path)
    node = F.col("nodeData")
    boosted = isinstance(model, GBTClassificationModel)
    total = F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, v: a + v)
    value = node["prediction"] if boosted else node["impurityStats"][1] / total
    inner = node["leftChild"] >= 0
    if boosted:
        weights = [float(w) for w in model.treeWeights]
    else:
        weights = [1.0 / model.getNumTrees] * model.getNumTrees
    names = F.array(*[F.lit(c) for c in features])
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        F.when(inner, names[node["split"]["featureIndex"]]).alias("feature"),
        F.when(inner, node["split"]["featureIndex"]).alias("position"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("left"), F.when(inner, node["rightChild"]).alias("right"),
        value.alias("value"), F.array(*[F.lit(w) for w in weights])[F.col("treeID")].alias("weight"),
        F.when(inner, node["gain"]).alias("gain"),
        (node["impurityStats"][0] if boosted else total).alias("rows"),
    )


def _flat(nodes: DataFrame) -> tuple[np.ndarray, ...]:
    """The node table as arrays, a tree after the other: roots, ways on, position, threshold and weight x value. It is as large as the
    model, whatever the data. From node n the way is at 2n + 1 if the value is at or under the threshold, else at 2n; a leaf leads to itself."""
    rows = nodes.select("tree", "node", "position", "threshold", "left", "right", "value", "weight").toArrow()
    held = {c: rows[c].fill_null(0).to_numpy() for c in rows.column_names}
    key = held["tree"].astype(np.int64) << 32 | held["node"]
    order = np.argsort(key)
    key, inner = key[order], rows["position"].is_valid().to_numpy()[order]

    def side(name: str) -> np.ndarray:
        child = np.searchsorted(key, key >> 32 << 32 | held[name][order].astype(np.int64))
        return np.where(inner, child, np.arange(len(key)))

    ways = np.column_stack([side("right"), side("left")]).ravel()
    roots = np.flatnonzero(key & 0xFFFFFFFF == 0)
    return roots, ways, held["position"][order].astype(np.int64), held["threshold"][order], (held["weight"] * held["value"])[order]


def walk(df: DataFrame, nodes: DataFrame, vector: str, keep: Sequence[str], depth: int) -> DataFrame:
    """`keep...` (which must name each row) and `total`, the summed weight x value of the leaves a row falls into; `vector` is an
    array column in the order of the features, all of one length. A value that is absent goes right.

    The node table goes to all tasks; a block of rows goes down all trees at once, a level a step, and leaves as one row each.
    """
    flat = df.sparkSession.sparkContext.broadcast(_flat(nodes))

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots, ways, position, threshold, share = flat.value
        for batch in stream:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                vectors = part.column(len(keep))
                there = vectors.drop_null()
                x = np.full((part.num_rows, int(position.max(initial=0)) + 1), np.nan)
                if len(there):
                    given = there.flatten().to_numpy(zero_copy_only=False).reshape(len(there), -1)
                    x[vectors.is_valid().to_numpy(zero_copy_only=False)] = given[:, : x.shape[1]]
                row = np.arange(len(x))[:, None]
                at = np.broadcast_to(roots, (len(x), len(roots)))
                for _ in range(depth):
                    at = ways[2 * at + (x[row, position[at]] <= threshold[at])]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(share[at].sum(axis=1))], [*keep, "total"])

    rows = df.select(*keep, F.col(vector).alias("_x"))
    kept = T.StructType([*rows.schema.fields[:-1], T.StructField("total", T.DoubleType())])
    return rows.mapInArrow(task, kept).groupBy(*keep).agg(F.sum("total").alias("total"))


def probability(total: Column, boosted: bool) -> Column:
    """Of a walked total: a forest's is the mean churn share, boosting's is half the log odds."""
    return 1 / (1 + F.exp(-2 * total)) if boosted else total


def importances(nodes: DataFrame, per_tree: bool) -> DataFrame:
    """`feature, importance`: the gain that splits on the feature bring, by rows, as a share of all; `per_tree` gives every
    tree the same say, as forests do."""
    gains = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
    if per_tree:
        sums = gains.groupBy("tree").agg(F.sum("g").alias("_all")).where("_all > 0")
        gains = gains.join(sums, "tree").withColumn("g", F.col("g") / F.col("_all"))
    by_feature = gains.groupBy("feature").agg(F.sum("g").alias("g"))
    whole = by_feature.agg(F.sum("g").alias("_whole"))
    return by_feature.crossJoin(F.broadcast(whole)).select("feature", (F.col("g") / F.col("_whole")).alias("importance"))
