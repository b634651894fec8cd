"""Deduplication and ranking that stay parallel under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _picked(table: DataFrame, keys: Sequence[str], order: Sequence[Column], pick) -> DataFrame:
    rest = [c for c in table.columns if c not in keys]
    row = F.struct(*rest)
    # The whole row breaks ties, so the result never depends on task order.
    position = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], row.alias("row"))
    chosen = table.groupBy(*keys).agg(pick(row, position).alias("row"))
    return chosen.select(*[f"row.{c}" if c in rest else c for c in table.columns])


def keep_first(table: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """First row per key in the given order.

    An aggregate, not row_number: duplicates of a hot key collapse before the shuffle.
    """
    return _picked(table, keys, order, F.min_by)


def keep_last(table: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    return _picked(table, keys, order, F.max_by)


def distinct_codes(table: DataFrame) -> DataFrame:
    return table.select("fund_code").dropna().distinct()
