import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm import cases
from tidemark.llm import sharding


def test_slots_are_gapless_and_growth_moves_only_into_the_new_shard(spark):
    rows = sharding.assign(cases.documents(spark)).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)
    assert set(slots) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_awkward_rows(spark):
    rows = sharding.assign(cases.awkward(spark)).collect()
    assert len(rows) == len(cases.ROWS)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((k, len((t or "").encode()) + 1) for k, t, _ in cases.ROWS)
    assert sharding.assign(cases.empty(spark)).count() == 0


def test_many_slot_buckets(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).unionAll(spark.range(500).select(F.lit(7).alias("doc_id"), F.lit("t").alias("text")))
    rows = sharding.slots(sharding.descend(docs, "doc_id", sharding.plain_tree(8), "shard").drop("text"), "shard", "doc_id", slot_rows=100).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == 3500 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_set_the_shares_and_confine_movement(spark):
    before = [(0, 0, 0, 1.0), (0, 1, 1, 2.0), (1, 0, 2, 3.0), (1, 0, 3, 1.0), (2, 0, 4, 1.0)]
    after = [(0, 0, 0, 1.0), (0, 1, 1, 2.0), (1, 0, 2, 3.0), (1, 0, 3, 4.0), (2, 0, 4, 1.0)]
    keys = spark.range(20000).withColumnRenamed("id", "k")
    rows = sharding.descend(sharding.descend(keys, "k", before, "a"), "k", after, "b").collect()
    region = {s: r for r, _, s, _ in before}
    share = Counter(r["a"] for r in rows)
    for _, _, shard, weight in before:
        p = weight / 8
        assert abs(share[shard] - 20000 * p) < 5 * math.sqrt(20000 * p * (1 - p))
    for r in rows:  # region 1 alone changed its weight: moves end there, and other regions exchange nothing
        assert r["a"] == r["b"] or region[r["b"]] == 1


def test_rows_without_an_id_spread_over_the_buckets(spark):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    rows = sharding.assign(docs).collect()
    assert len({r["shard"] for r in rows}) == 1 and sorted(r["slot"] for r in rows) == list(range(4000))
