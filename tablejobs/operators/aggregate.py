"""Grouped counts, sums and statistics.

Every aggregate here is planned by Spark as a partial (map-side) aggregate,
one hash Exchange on the grouping keys, and a final aggregate. The partial
step collapses each key to one row per input partition before the shuffle,
so a key that holds a third of all rows costs one row per map task on the
wire, not a third of the table in one reducer.
"""

from __future__ import annotations

import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.operators.ordering import distinct_rows
from tablejobs.session import ensure_unique_columns


def group_count(df: DataFrame, *keys: str, name: str = "counts",
                order: bool = True) -> DataFrame:
    """Rows per group as ``name``, sorted by the keys (ascending, NULLS FIRST)."""
    counted = ensure_unique_columns(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))
    return counted.orderBy(*keys) if order else counted


def count_values(df: DataFrame, *keys: str, value: str, name: str = "counts") -> DataFrame:
    """Per group, how many rows have a non-NULL ``value``."""
    return ensure_unique_columns(df.groupBy(*keys).agg(F.count(value).alias(name)))


def group_sum(df: DataFrame, key: str, column: str, name: str | None = None) -> DataFrame:
    """Sum of ``column`` per ``key``, as ``name`` (``sum(column)`` if not given)."""
    return ensure_unique_columns(
        df.groupBy(key).agg(F.sum(column).alias(name or f"sum({column})")))


_COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
            "=": operator.eq, "==": operator.eq, "!=": operator.ne, "<>": operator.ne}


def having_count(df: DataFrame, key: str, op: str, threshold: int,
                 name: str = "counts") -> DataFrame:
    """Count per key, then keep groups whose count passes ``op threshold``
    (a HAVING clause: the filter runs after the final aggregate)."""
    if op not in _COMPARE:
        raise ValueError(f"unknown comparison {op!r}; use one of {sorted(_COMPARE)}")
    counted = ensure_unique_columns(df.groupBy(key).agg(F.count(F.lit(1)).alias(name)))
    return counted.filter(_COMPARE[op](F.col(name), threshold))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """Whole-table count as a one-row DataFrame (partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, *cols: str, name: str = "n") -> DataFrame:
    """Number of distinct tuples of ``cols`` (whole rows when none are given);
    an all-NULL tuple counts once (``countDistinct`` would drop it)."""
    return distinct_rows(df, *cols).agg(F.count(F.lit(1)).alias(name))


def stats_by(df: DataFrame, key: str, value: str, digits: int = 6) -> DataFrame:
    """Average (rounded), minimum and maximum of ``value`` per ``key``."""
    return ensure_unique_columns(df.groupBy(key).agg(
        F.round(F.avg(value), digits).alias("avg_v"),
        F.min(value).alias("min_v"),
        F.max(value).alias("max_v"),
    ))
