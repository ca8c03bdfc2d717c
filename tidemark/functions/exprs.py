"""Column expressions shared by the rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

EPSILON = 1e-6


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clamp, leaving NULL alone (`least` / `greatest` would replace it)."""
    out = x
    if low is not None:
        out = F.when(x < low, F.lit(low).cast("double")).otherwise(out)
    if high is not None:
        out = F.when(x > high, F.lit(high).cast("double")).otherwise(out)
    return out


def at_least(x: Column, low: float) -> Column:
    return F.when(x < low, F.lit(low)).otherwise(x)


def flag(condition: Column) -> Column:
    """0/1 with NULL counted as 0."""
    return F.when(condition, 1).otherwise(0)


def lookup(key: Column, table: Mapping[str, int | float | str], default) -> Column:
    """Scalar map as a literal; meant for maps of a few entries."""
    entries = F.create_map(*[F.lit(v) for v in chain.from_iterable(table.items())])
    return F.coalesce(F.element_at(entries, key), F.lit(default))


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def months_since_zero(year: Column, month: Column) -> Column:
    return year * 12 + month


def band(x: Column, cuts: Sequence[float], labels: Sequence[str], other: str | None) -> Column:
    """Bands closed on the right: (0, c1], (c1, c2], ... ; values outside give `other`."""
    edges = [0.0, *cuts, 1.0]
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (x > low) & (x <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out.otherwise(F.lit(other))


def as_percent(x: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", x * 100)


def as_money(x: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(x, 0))


def as_short_money(x: Column) -> Column:
    """$1.2M, $3.4K or $56."""
    return (
        F.when(x >= 1e6, F.format_string("$%.1fM", x / 1e6))
        .when(x >= 1e3, F.format_string("$%.1fK", x / 1e3))
        .otherwise(F.format_string("$%.0f", x))
    )


def money_sum(amount: Column | str) -> Column:
    """Total of amounts in cents, exact and so independent of the order of addition."""
    x = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(x.cast("decimal(18,2)")).cast("double")


def attach(df: DataFrame, one_row: DataFrame | Row, names: Sequence[str] | None = None) -> DataFrame:
    """Put a one-row aggregate (its columns `names`) on every row. An ungrouped aggregate is one row by
    construction, so the broadcast does not grow with the data. A row of numbers already taken becomes literals."""
    if isinstance(one_row, Row):
        return df.withColumns({n: F.lit(one_row[n]).cast("double") for n in names or one_row.asDict()})
    return df.crossJoin(F.broadcast(one_row.select(*names) if names else one_row))
