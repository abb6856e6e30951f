"""Derived and converted columns built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fahrenheit_to_celsius(value: str | Column) -> Column:
    """(v - 32) * 5 / 9, evaluated left to right in double precision."""
    return (_col(value) - 32) * 5 / 9


def to_celsius(value: str | Column, unit: str | Column, fahrenheit: str,
               celsius: str) -> Column:
    """Temperature in Celsius: rows whose unit is ``fahrenheit`` (ignoring case
    and surrounding spaces) are converted, rows in ``celsius`` pass through, and
    any other unit, or none, gives NULL."""
    label = F.upper(F.trim(_col(unit)))            # units compare case-blind
    return (F.when(label == F.lit(fahrenheit.strip().upper()), fahrenheit_to_celsius(value))
            .when(label == F.lit(celsius.strip().upper()), _col(value).cast("double")))


def date_parts(ts: str | Column) -> dict[str, Column]:
    """Calendar date and year of a timestamp or date column."""
    c = _col(ts)
    return {"d": F.to_date(c), "y": F.year(c)}
