"""Synthetic minority rows: points between a minority member and one of its near neighbours."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import attach
from tidemark.functions.ranks import quantile_row
from tidemark.operators.draws import uniform
from tidemark.session import cut_lineage

PROJECTIONS = 6
REACH = 24
ROWS_PER_RANGE = 50_000


def _points(minority: DataFrame, features: Sequence[str], id_column: str) -> DataFrame:
    return minority.select(
        F.col(id_column).alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    )


def line_neighbours(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """`id, x, near`: the k closest of the points that lie next to a point on some of several random lines.

    The neighbours are near ones and not proven nearest, which is all the interpolation needs; the work is
    linear and the method the same at every size. A line is cut by position into ranges of about
    ROWS_PER_RANGE points; points of equal position are dealt over the ranges that their position spans.
    The outermost REACH points of a range are shown to its neighbour too, so no pair is lost at a border.
    """
    size = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
    width, ranges = size["width"], size["n"] // ROWS_PER_RANGE + 1
    draw = random.Random(seed)
    per_line = None
    for line in range(PROJECTIONS):
        direction = F.array(*[F.lit(draw.gauss(0.0, 1.0)) for _ in range(width)])
        on_line = F.aggregate(F.zip_with("x", direction, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        placed = points.withColumn("at", on_line)
        cuts = placed.agg(
            F.percentile_approx("at", [i / ranges for i in range(1, ranges)] or [1.0], 10 * ranges).alias("cuts")
        )
        below = F.size(F.filter("cuts", lambda c: c < F.col("at")))
        equal = F.size(F.filter("cuts", lambda c: c == F.col("at")))
        ranged = attach(placed, cuts).withColumn(
            "range", below + F.pmod(F.xxhash64("id", F.lit(seed)), equal + 1).cast("int")
        ).drop("cuts")
        if ranges > 1:
            ends = ranged.withColumns({
                "low": F.row_number().over(Window.partitionBy("range").orderBy("at", "id")),
                "high": F.row_number().over(Window.partitionBy("range").orderBy(F.col("at").desc(), F.col("id").desc())),
            })
            shown = F.array_compact(F.array(
                F.col("range"), F.when(F.col("low") <= REACH, F.col("range") - 1), F.when(F.col("high") <= REACH, F.col("range") + 1)
            ))
            ranged = ends.withColumn("own", F.col("range")).withColumn("range", F.explode(shown))
        else:
            ranged = ranged.withColumn("own", F.col("range"))
        beside = Window.partitionBy("range").orderBy("own", "at", "id").rowsBetween(-REACH, REACH)
        candidates = F.collect_list(F.struct("id", "x")).over(beside)
        found = (
            ranged.withColumn("near", _closest(candidates, k)).where(F.col("own") == F.col("range"))
            .select("id", "x", "near")
        )
        per_line = found if per_line is None else per_line.unionByName(found)
    merged = per_line.groupBy("id").agg(
        F.first("x").alias("x"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")
    )
    best = F.slice(F.array_sort("near"), 1, k)
    near = F.when(F.size(best) > 0, F.transform(best, lambda c: c["x"])).otherwise(F.array("x"))
    return merged.select("id", "x", near.alias("near"))


def _closest(candidates: Column, k: int) -> Column:
    """The k candidates nearest to this row's `x`, as (gap, id, x), without the row itself."""
    def gap(other: Column) -> Column:
        squares = F.zip_with(F.col("x"), other, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda s, v: s + v)

    others = F.filter(candidates, lambda c: c["id"] != F.col("id"))
    measured = F.transform(others, lambda c: F.struct(gap(c["x"]).alias("gap"), c["id"].alias("id"), c["x"].alias("x")))
    return F.slice(F.array_sort(measured), 1, k)


def oversample(
    train: DataFrame, features: Sequence[str], label: str = "label", id_column: str = "loyalty_number",
    k: int = 5, seed: int = 42,
) -> DataFrame:
    """`train` plus as many synthetic rows of the smaller class as bring the classes to 1:1, with `synthetic`.

    The features should be scaled. Each of its rows is drawn equally often, and one more time for the remainder.
    """
    sizes = train.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")).first()
    smaller = 1.0 if sizes["p"] <= sizes["n"] else 0.0
    minority, wanted = min(sizes["p"], sizes["n"]), abs(sizes["n"] - sizes["p"])
    marked = train.withColumn("synthetic", F.lit(0))
    if minority < 2 or wanted <= 0:
        return marked
    points = cut_lineage(_points(train.where(F.col(label) == smaller), features, id_column))
    near = line_neighbours(points, k, seed)

    each, extra = divmod(wanted, minority)
    u = uniform("id", seed)
    one_more = F.lit(0)
    if extra:
        # exactly `extra` points lie at or under this quantile
        near = attach(near, quantile_row(points.select(u.alias("u")), {"_cut": ("u", extra / minority)}))
        one_more = (u <= F.col("_cut")).cast("int")
    drawn = near.withColumn("_draws", F.lit(each) + one_more).where("_draws > 0").withColumn(
        "draw", F.explode(F.sequence(F.lit(1), F.col("_draws")))
    )
    pick = F.element_at("near", (F.pmod(F.xxhash64("id", "draw", F.lit(seed)), F.size("near")) + 1).cast("int"))
    bits = F.xxhash64("id", "draw", F.lit(seed + 1)).bitwiseAND(F.lit((1 << 52) - 1))
    step = bits / F.lit(float(1 << 52))
    made = drawn.withColumns({"_pick": pick, "_step": step}).withColumn(
        "_new", F.zip_with("x", "_pick", lambda a, b: a + (b - a) * F.col("_step"))
    )
    rows = made.select(
        F.col("id").alias(id_column), F.lit(smaller).alias(label),
        *[F.col("_new")[i].alias(c) for i, c in enumerate(features)], F.lit(1).alias("synthetic"),
    )
    return marked.select(*rows.columns).unionByName(rows)
