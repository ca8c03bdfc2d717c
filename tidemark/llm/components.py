"""Connected components by alternating large and small stars (Kiveris et al., 2014).

Each round writes its links to the shared folder, so that lineage stays short and a lost executor costs a
re-read. A node's neighbours are only ever reduced to their minimum (combined before the shuffle) and joined
back; no neighbourhood is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import staged


def _large(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return (
        both.join(least, "a").where((F.col("b") > F.col("a")) & (F.col("b") != F.col("least")))
        .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    )


def _small(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. Rows here have a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    joined = links.join(least, "a")
    moved = joined.where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def roots(links: DataFrame) -> DataFrame:
    """Links (a, b) of long nodes in; (node, root) out for every node that is linked and not its own root.

    The root is the smallest node of the component. Self-links and repeated links change nothing.
    """
    now = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before, state = None, _state(now)
    while state[0] and state != before:
        now = staged(_small(_large(now)))
        before, state = state, _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
