"""Projections, filters and column edits (all narrow: no shuffle).

Filters on scan columns reach the Parquet reader as pushed filters, and
projections prune the read schema, so these compose freely in front of the
wide operators.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.functions.columns import date_parts, to_celsius
from tablejobs.session import ensure_unique_columns, name_fold


def select_cols(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols)


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` equals ``value`` (NULL never matches)."""
    return df.filter(F.col(column) == F.lit(value))


def filter_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """SQL LIKE, case-sensitive: ``%`` any run, ``_`` one character."""
    return df.filter(F.col(column).like(pattern))


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; a name that is not a column is an error, not a no-op."""
    fold = name_fold(df.sparkSession)
    present = {fold(c) for c in df.columns}
    unknown = [old for old in mapping if fold(old) not in present]
    if unknown:
        raise ValueError(f"no such columns to rename: {unknown}")
    renamed = df.withColumnsRenamed(mapping)
    counts = Counter(fold(c) for c in renamed.columns)
    clashes = sorted({new for new in mapping.values() if counts[fold(new)] > 1})
    if clashes:                      # only the names this rename creates are checked
        raise ValueError(f"renaming would duplicate columns: {clashes}")
    return renamed


def derive_dates(df: DataFrame, ts: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keep ``keep`` columns and add the calendar date ``d`` and year ``y`` of ``ts``."""
    parts = date_parts(ts)
    return ensure_unique_columns(df.select(*keep, parts["d"].alias("d"), parts["y"].alias("y")))


def convert_units(df: DataFrame, value: str, unit: str, fahrenheit: str = "F",
                  keep: tuple[str, ...] = (), out: str = "value_c",
                  celsius: str = "C") -> DataFrame:
    """Bring a temperature recorded in F or C to Celsius (see ``to_celsius``)."""
    return ensure_unique_columns(
        df.select(*keep, to_celsius(value, unit, fahrenheit, celsius).alias(out)))
