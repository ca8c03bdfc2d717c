"""Exact order statistics without putting a table, or a large group, into one task.

`percentile` keeps a value -> count map of its whole group, and a window with no partition sorts
everything in one task. Here rows are first counted per value range; the counts say in which range a
wanted position lies, and only the values of those ranges are shuffled, counted and put in order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# the 1,024th part of the octave that a value lies in; ranges are in the order of their values
OCTAVE_PART = """CASE WHEN _v = 0 THEN 0
    WHEN _v > 0 THEN 1 + bigint((least(log2(_v), 1025D) + 1080) * 1024)
    ELSE -1 - bigint((least(log2(-_v), 1025D) + 1080) * 1024) END"""


def quantiles(
    df: DataFrame, wanted: Mapping[str, tuple[str, float]], by: Sequence[str] = ()
) -> DataFrame:
    """A row per group (one row without `by`): `by...`, the wanted quantiles `{name: (column,
    prob)}` and `<column>__n`, the number of values. Exact, linear between neighbours.

    Two passes over the rows. The first counts rows per range (the 1,024th part of an octave), a running sum over
    ranges gives each wanted position its range and its place there. The second keeps the rows of those ranges
    and counts equal values, so ties and copies combine before the shuffle; their running sum finds the value.
    A column whose values differ by less than a thousandth of their size has few ranges, and then a
    range's distinct values are sorted in one task, which spills.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    probs = {c: sorted({p for name, p in wanted.values() if name == c}) for c in columns}
    keys = [*by, "_c"]
    # NaN is an absent value here
    entries = ", ".join(f"struct({k} AS _c, nanvl(double(`{c}`), NULL) AS _v)" for k, c in enumerate(columns))
    rows = df.selectExpr(*[f"`{c}`" for c in by], f"inline(array({entries}))").withColumn("_d", F.expr(OCTAVE_PART))

    # a NULL range holds the absent values, and comes first
    group = Window.partitionBy(*keys).orderBy("_d")
    ranges = rows.groupBy(*keys, "_d").agg(F.count("_v").alias("_size")).withColumns({
        "_n": F.sum("_size").over(Window.partitionBy(*keys)),
        "_ahead": F.sum("_size").over(group.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"),
        "_lead": F.row_number().over(group) == 1,
    })
    asked = " ".join(f"WHEN _c = {k} THEN array({', '.join(f'{p!r}D' for p in probs[c])})" for k, c in enumerate(columns))
    sought = ranges.selectExpr(
        *[f"`{k}`" for k in keys], "_d", "_n", "_size", "_ahead", "_lead",
        f"""inline(concat(
            array(named_struct('_p', CAST(NULL AS DOUBLE), '_side', 0, '_rank', CAST(NULL AS BIGINT))),
            flatten(transform(CASE {asked} END, p -> array(
                named_struct('_p', p, '_side', 0, '_rank', bigint(floor(p * (_n - 1))) - _ahead),
                named_struct('_p', p, '_side', 1, '_rank', bigint(ceil(p * (_n - 1))) - _ahead))))))""",
    ).where("(_p IS NULL AND _lead) OR (_rank >= 0 AND _rank < _size)").drop("_size", "_ahead", "_lead")

    # without groups a row per wanted position; with groups at most a row per range
    places = sought.where("_p IS NOT NULL").select("_c", "_d")
    places = F.broadcast(places.distinct() if by else places)
    counts = rows.join(places, ["_c", "_d"], "left_semi").groupBy(*keys, "_d", "_v").agg(F.count(F.lit(1)).alias("_m"))
    ordered = counts.withColumn("_upto", F.sum("_m").over(Window.partitionBy(*keys, "_d").orderBy("_v")))

    other = ordered.withColumnsRenamed({k: f"_right_{k}" for k in [*keys, "_d"]})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in [*keys, "_d"]]
    # without groups the wanted positions are a handful, so the ordered values stay where they are
    lead = sought if by else F.broadcast(sought)
    inside = F.expr("_rank >= _upto - _m AND _rank < _upto")
    found = lead.join(other, [*on, inside], "left") if by else lead.where("_p IS NOT NULL").join(other, [*on, inside])
    if not by:
        found = found.unionByName(sought.where("_p IS NULL"), allowMissingColumns=True)

    def value(c: str, p: float) -> str:
        at = f"_c = {columns.index(c)} AND _p = {p!r}D"
        low, high = (f"max(_v) FILTER (WHERE {at} AND _side = {side})" for side in (0, 1))
        place = f"({p!r}D * (max(_n) FILTER (WHERE {at}) - 1))"
        return (
            f"CASE WHEN {low} = {high} THEN {low} "
            f"ELSE (ceil({place}) - {place}) * {low} + ({place} - floor({place})) * {high} END"
        )

    return found.groupBy(*by).agg(
        *[F.expr(f"{value(c, p)} AS `{name}`") for name, (c, p) in wanted.items()],
        *[F.expr(f"coalesce(max(_n) FILTER (WHERE _c = {k}), 0L) AS `{c}__n`") for k, c in enumerate(columns)],
    )


def quantile_row(df: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row with a column per wanted quantile: `{name: (column, prob)}`."""
    return quantiles(df, wanted).select(*wanted)


def quantile_table(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """`by..., column, prob, n, value` for several numeric columns."""
    named = {f"{c}__{i}": (c, float(p)) for c in columns for i, p in enumerate(probs)}
    wide = quantiles(df, named, by)
    entries = ", ".join(
        f"struct('{c}' AS column, {p!r}D AS prob, `{c}__n` AS n, `{name}` AS value)"
        for name, (c, p) in named.items()
    )
    return wide.selectExpr(*[f"`{c}`" for c in by], f"inline(array({entries}))")


def running_totals(df: DataFrame, key: str, measures: Mapping[str, Column]) -> DataFrame:
    """`key`, each measure summed over rows of equal key, and `<measure>_upto`, its running total
    in key order. Works on one row per distinct key, cut into as many key ranges as the session
    has shuffle partitions."""
    ranges = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    totals = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.sum(m).alias(name) for name, m in measures.items()]
    )
    cuts = totals.agg(
        F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 10 * ranges).alias("cuts")
    )
    cut = totals.crossJoin(F.broadcast(cuts)).select(
        *totals.columns, F.size(F.filter("cuts", lambda c: c < F.col(key))).alias("range")
    )
    # one row per range
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("range").agg(*[F.sum(m).alias(f"_{m}") for m in measures]).select(
        "range", *[F.coalesce(F.sum(f"_{m}").over(before), F.lit(0)).alias(f"_{m}") for m in measures]
    )
    within = Window.partitionBy("range").orderBy(key)
    return cut.join(F.broadcast(offsets), "range").select(
        key, *measures,
        *[(F.col(f"_{m}") + F.sum(m).over(within)).alias(f"{m}_upto") for m in measures],
    )


def percent_rank_mean(x: str) -> Column:
    """Share of rows at or below, ties on their mean rank. For profile tables of a few rows."""
    everyone = Window.partitionBy(F.lit(0))
    ordered = everyone.orderBy(F.col(x).asc_nulls_last())
    ties = F.count(F.lit(1)).over(Window.partitionBy(x))
    share = (F.rank().over(ordered) + (ties - 1) / 2) / F.count(x).over(everyone)
    return F.when(F.col(x).isNotNull(), share)
