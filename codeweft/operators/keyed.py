"""Per-key choices as aggregates.

``max_by`` and ``min_by`` combine on the map side, so a hot key costs one row
per task in the shuffle; a ranking window would move and sort all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: str | Column, best) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    by = F.col(order) if isinstance(order, str) else order
    row = best(F.struct(*rest), by).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    """Log compaction: the row with the greatest ``order`` of each key."""
    return _pick(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: Sequence[str], order: str | Column) -> DataFrame:
    """The row with the least ``order`` of each key."""
    return _pick(df, keys, order, F.min_by)
