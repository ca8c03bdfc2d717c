"""Exact top-k inner products by the three-phase uniform threshold (Cao and Wang, 2004).

The components are cut into `nodes` slices. A node holds its slice of the vectors alone and scores by it alone; a vector's score is
the sum of its nodes' scores.

1. Each node gathers the k + 1 best local scores for a query of each block, and of these the `GATHER` (k + 1) best. Scores have either sign, so the sum of a list's entries bounds
   nothing; the few listed vectors are scored in full, by a join, and the (k + 1)-th best of them is a safe cutoff (one
   more than k, since a query is no answer to itself).
2. The cutoff is sent out. A vector that reaches it has a local score of cutoff / nodes or more at some node, so every node returns
   its entries from that share up; those equal to the share only if their id can still win the tie.
3. Entries that all nodes returned are complete, and the (k + 1)-th best of them may raise the cutoff. An entry that lacks nodes has less than
   the share there; what cannot reach the cutoff goes, the rest is scored in full by a join, and the k best are exact.

Queries and vectors meet in blocks: (node, query block, vector block) triples are dealt to tasks, and a node scores a block pair by one
matrix product of its slices. Equal vectors are one vector with its smallest k + 1 ids, for queries and candidates alike.

Vectors that are null, or hold null or non-finite components, take no part; neither do null ids. Vectors shorter than the
longest count as ending in zeros. Ties go to the smaller id. Equal rows
count once; an id with several vectors stands, and is answered, once for each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import bytewise
from tidemark.llm.staging import staged

NODES = 2
SCALE = 64
VECTOR_BLOCK = 8192
QUERY_BLOCK = 1024
GATHER = 8  # lists of so many times k + 1 entries are scored in full: more of them raise the cutoff


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, the component taken as double; null if any is null or not finite."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of longs, filled up with zeros, as doubles: sums stay exact below 2**53."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, bytewise.ranges(np.zeros(len(size), np.int64), size)] = flat
    return out


def _slices(width: int, nodes: int) -> list[slice]:
    cuts = np.linspace(0, width, nodes + 1).astype(int)
    return [slice(int(a), int(b)) for a, b in zip(cuts, cuts[1:])]


def _dot(a: Column, b: Column) -> Column:
    """The inner product of two arrays of longs; the shorter one ends in zeros."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0)))
    return F.aggregate(products, F.lit(0).cast("long"), lambda s, v: s + v)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, nodes: int = NODES) -> DataFrame:
    """(query_id, rank, key, score): the k best other rows of every query row."""
    rows = vectors.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), scaled(F.col(vector), scale).alias("x"), is_query.alias("q"))
    rows = rows.where("x is not null")
    least = Window.partitionBy("x").orderBy("id")
    rows = rows.distinct()
    kept = rows.select("id", "x").withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    distinct = kept.groupBy("x").agg(F.min("id").alias("least"), F.sort_array(F.collect_list("id")).alias("ids"))
    asking = rows.where("q").groupBy("x").agg(F.count(F.lit(1)).alias("asked"))
    # numbered where they are written, so that blocks are even and stay as they are
    listed = staged(
        distinct.join(asking, "x", "left").select(
            F.monotonically_increasing_id().alias("v"), "x", "ids", "least", F.col("asked").isNotNull().alias("asked"),
        )
    )
    facts = listed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asked").cast("int")).alias("q"), F.max(F.size("x")).alias("w")).first()
    width = facts["w"] or 1
    cuts = _slices(width, min(nodes, width))
    v_blocks, q_blocks = facts["n"] // VECTOR_BLOCK + 1, (facts["q"] or 0) // QUERY_BLOCK + 1
    block = F.xxhash64("v")
    vectors_ = listed.select("v", "x", "least", F.pmod(block, F.lit(v_blocks)).cast("int").alias("vb"))
    queries = listed.where("asked").select(F.col("v").alias("qv"), "x", F.pmod(block, F.lit(q_blocks)).cast("int").alias("qb"))
    part = F.explode(F.array(*[
        F.struct(F.lit(j).alias("node"), F.slice("x", c.start + 1, c.stop - c.start).alias("part")) for j, c in enumerate(cuts)
    ])).alias("own")

    def met(q: DataFrame, *extra: str) -> tuple[DataFrame, DataFrame]:
        """Both sides of every (node, query block, vector block)."""
        left = q.select("qb", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1))).alias("vb"), "qv", "x", *extra)
        right = vectors_.select(F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"), "vb", "v", "x", "least")
        return (
            left.select("qb", "vb", "qv", *extra, part).select("qb", "vb", "qv", *extra, "own.*").groupBy("node", "qb", "vb"),
            right.select("qb", "vb", "v", "least", part).select("qb", "vb", "v", "least", "own.*").groupBy("node", "qb", "vb"),
        )

    def local(left: pa.Table, right: pa.Table) -> np.ndarray:
        """The node's scores of a block pair."""
        c = cuts[left["node"][0].as_py()]
        return _matrix(left["part"].combine_chunks(), c.stop - c.start) @ _matrix(right["part"].combine_chunks(), c.stop - c.start).T

    def entries(left: pa.Table, right: pa.Table, scores: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.Table:
        return pa.table({
            "qv": left["qv"].combine_chunks().take(pa.array(i)), "v": right["v"].combine_chunks().take(pa.array(j)),
            "least": right["least"].combine_chunks().take(pa.array(j)),
            "node": pa.array(np.full(len(i), left["node"][0].as_py(), np.int32)), "s": pa.array(scores[i, j].astype(np.int64)),
        })

    nothing = pa.table({n: pa.array([], t) for n, t in (("qv", pa.int64()), ("v", pa.int64()), ("least", pa.int64()), ("node", pa.int32()), ("s", pa.int64()))})
    shape = "qv long, v long, least long, node int, s long"

    def gather(key_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return nothing
        scores = local(left, right)
        most = min(k + 1, scores.shape[1])
        best = np.argpartition(scores, scores.shape[1] - most, axis=1)[:, scores.shape[1] - most:]
        return entries(left, right, scores, np.repeat(np.arange(len(scores)), most), best.ravel())

    def in_full(pairs: DataFrame) -> DataFrame:
        """(qv, v, least, score) of (qv, v)."""
        return (
            pairs.join(vectors_.select("v", "least", F.col("x").alias("xv")), "v").join(queries.select("qv", F.col("x").alias("xq")), "qv")
            .select("qv", "v", "least", _dot(F.col("xq"), F.col("xv")).alias("score"))
        )

    def kth(scored: DataFrame) -> DataFrame:
        """(qv, cutoff, rival): the (k + 1)-th best score of a query that has so many, and that vector's id."""
        order = Window.partitionBy("qv").orderBy(F.col("score").desc(), "least")
        return scored.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).groupBy("qv").agg(
            F.when(F.count(F.lit(1)) == k + 1, F.min("score")).alias("cutoff"),
            F.max_by("least", "n").alias("rival"),
        )

    left, right = met(queries)
    local_best = Window.partitionBy("qv", "node").orderBy(F.col("s").desc(), "v")
    lists = left.cogroup(right).applyInArrow(gather, shape)
    lists = lists.withColumn("n", F.row_number().over(local_best)).where(F.col("n") <= GATHER * (k + 1)).select("qv", "v").distinct()
    lowest = F.lit(-(2**52))
    sent = staged(queries.join(kth(in_full(lists)), "qv").select("qv", "x", "qb", F.coalesce("cutoff", lowest).alias("cutoff"), "rival"))

    def collect(key_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return nothing
        scores = local(left, right)
        share = left["cutoff"].to_numpy().astype(float)[:, None] / len(cuts)
        wins = right["least"].to_numpy()[None, :] <= left["rival"].to_numpy()[:, None]
        i, j = np.nonzero((scores > share) | ((scores == share) & wins))
        return entries(left, right, scores, i, j)

    left, right = met(sent, "cutoff", "rival")
    returned = left.cogroup(right).applyInArrow(collect, shape)
    sums = staged(returned.groupBy("qv", "v", "least").agg(F.sum("s").alias("known"), F.count(F.lit(1)).alias("held")))
    complete = sums.where(F.col("held") == len(cuts)).select("qv", "v", "least", F.col("known").alias("score"))
    raised = kth(complete).select("qv", F.col("cutoff").alias("raised"))
    bounds = sent.select("qv", "cutoff").join(raised, "qv", "left").select("qv", "cutoff", F.greatest("cutoff", "raised").alias("edge"))
    lacking = sums.where(F.col("held") < len(cuts)).join(bounds, "qv")
    reach = F.col("known") + (len(cuts) - F.col("held")) * F.col("cutoff") / len(cuts)
    exact = complete.unionByName(in_full(lacking.where(reach >= F.col("edge")).select("qv", "v")))
    # k + 1 vectors, ties by their smallest ids, hold the answer; only their ids are spread out
    first = Window.partitionBy("qv").orderBy(F.col("score").desc(), "least")
    leading = exact.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).select("qv", "v", "score")
    ids = leading.join(listed.select("v", "ids"), "v").select("qv", "score", F.explode("ids").alias(key))
    best = Window.partitionBy("qv").orderBy(F.col("score").desc(), F.col(key))
    answer = ids.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    asked = rows.where("q").select(F.col("id").alias("query_id"), "x").join(listed.where("asked").select("x", F.col("v").alias("qv")), "x")
    final = Window.partitionBy("query_id", "qv").orderBy(F.col("score").desc(), F.col(key))
    return (
        asked.select("query_id", "qv").join(answer, "qv").where(F.col(key) != F.col("query_id"))
        .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
        .select("query_id", "rank", key, "score")
    )
