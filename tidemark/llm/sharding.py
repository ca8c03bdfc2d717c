"""Hierarchical weighted hash tree: documents go down region, rack and shard by weighted hash draws.

At each level every child of the node draws u from a hash of the level, the child's name and the key, and the
child with the smallest -ln(u) / weight wins; its chance is its weight's share. A node's weight is the sum of
the weights below it. When a weight changes, only the draws of the nodes above it change: a row moves only into
or out of a subtree whose weight changed, and never between two others.

Law `key`: the key and the tree alone decide. `plain_tree(n)` gives the first eight shards two regions of two
racks of two; each further shard is a region of its own, so one more shard takes rows only into itself.

Everything is DataFrame functions. Null keys draw as an empty text; equal rows get equal shards and their own
slots; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.staging import staged

#: (region, rack, shard, weight)
Leaf = tuple[int, int, int, float]
BASE_SHARDS = 8
SLOT_ROWS = 65536  # rows that one slot bucket holds on average


def plain_tree(shards: int) -> list[Leaf]:
    """Shards 0 .. n-1 of weight 1."""
    return [
        (n // 4, n // 2 % 2, n, 1.0) if n < BASE_SHARDS else (n - BASE_SHARDS + 2, 0, n, 1.0)
        for n in range(shards)
    ]


def _winner(key: Column, level: str, children: dict[int, float]) -> Column:
    """The child with the smallest draw; ties go to the smaller name."""
    if len(children) == 1:
        return F.lit(next(iter(children)))
    draws = []
    for name, weight in sorted(children.items()):
        digest = F.md5(F.concat(F.lit(f"{level}/{name}/"), key))
        number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
        draws.append(F.struct((-F.log((number + 1) / float(2**52 + 1)) / weight).alias("draw"), F.lit(name).alias("name")))
    return F.least(*draws)["name"]


def _cases(at: Column, choices: dict[int, Column]) -> Column:
    names = sorted(choices)
    out = choices[names[-1]]
    for name in reversed(names[:-1]):
        out = F.when(at == name, choices[name]).otherwise(out)
    return out


def descend(docs: DataFrame, key: str, tree: Iterable[Leaf], out: str) -> DataFrame:
    """Add the shard of each row by its key: three levels, each level one column."""
    leaves = [leaf for leaf in tree if leaf[3] > 0]
    if not leaves:
        raise ValueError("a tree needs a shard of positive weight")
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    regions: dict[int, float] = {}
    racks: dict[int, dict[int, float]] = {}
    shards: dict[tuple[int, int], dict[int, float]] = {}
    for region, rack, shard, weight in leaves:
        regions[region] = regions.get(region, 0) + weight
        racks.setdefault(region, {})[rack] = racks.get(region, {}).get(rack, 0) + weight
        shards.setdefault((region, rack), {})[shard] = weight
    region_col, rack_col = f"__{out}_region", f"__{out}_rack"
    by_region = {r: _winner(text, f"rack/{r}", c) for r, c in racks.items()}
    by_rack = {
        r: _cases(F.col(rack_col), {k: _winner(text, f"shard/{r}/{k}", shards[r, k]) for k in racks[r]})
        for r in racks
    }
    return (
        docs.withColumn(region_col, _winner(text, "region", regions))
        .withColumn(rack_col, _cases(F.col(region_col), by_region))
        .withColumn(out, _cases(F.col(region_col), by_rack).cast("int"))
        .drop(region_col, rack_col)
    )


def slots(rows: DataFrame, shard: str, key: str, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Add `slot`: 0, 1, ... within each shard.

    A shard is cut into hash buckets of about `slot_rows` rows; small tables of bucket counts give each bucket its
    first slot, and rows are numbered within their bucket. The bucket is drawn from all columns, so many rows without a key, or
    of one key, spread over the buckets. Equal rows are one row with a count until the end, so a row repeated without
    bound fills no task.
    """
    columns = rows.columns
    equal = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    buckets = rows.count() // slot_rows + 1
    others = [c for c in columns if c not in (key, shard)]
    whole = F.concat_ws("/", F.coalesce(F.col(key).cast("string"), F.lit("")), *[F.col(c).cast("string") for c in others])
    digest = F.substring(F.md5(whole), 20, 13)
    equal = equal.withColumn("__bucket", F.conv(digest, 16, 10).cast("long") % buckets)
    before = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        equal.groupBy(shard, "__bucket").agg(F.sum("__copies").alias("__n"))
        .select(F.col(shard).alias("__s"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    )
    order = [F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in others]]
    inner = Window.partitionBy(shard, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = equal.withColumn("__within", F.coalesce(F.sum("__copies").over(inner), F.lit(0)))
    return (
        placed.join(first, (F.col(shard) == F.col("__s")) & (F.col("__bucket") == F.col("__b")))
        .withColumn("__i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
        .select(*columns, (F.col("__first") + F.col("__within") + F.col("__i")).alias("slot"))
    )


def assign(docs: DataFrame, shards: int = BASE_SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's size, text checksum, shard, slot, and its shard in the tree with one more shard."""
    bytes_ = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias(key), (F.octet_length(bytes_).cast("long") + 1).alias("size"), F.crc32(bytes_.cast("binary")).alias("text_crc32"),
    )
    rows = descend(rows, key, plain_tree(shards), "shard")
    rows = descend(rows, key, plain_tree(shards + 1), "grown_shard")
    return slots(staged(rows), "shard", key)  # numbers alone, so the texts are read once
