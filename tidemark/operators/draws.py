"""Repeatable random numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 52


def uniform(id_column: str, seed: int) -> Column:
    """Repeatable number in [0, 1) per id: it does not depend on partitioning."""
    mask = (1 << _BITS) - 1
    bits = F.xxhash64(F.col(id_column), F.lit(seed)).bitwiseAND(F.lit(mask))
    return bits / F.lit(float(1 << _BITS))
