"""Distinct rows, top-n, first row and the reduce-style maximum.

``orderBy(...).limit(n)`` is planned as TakeOrderedAndProject: each task keeps
its own best ``n`` rows and only those are merged, so the cost of a top-n is
one scan plus n rows per task. A limit without an order returns arbitrary
rows; these helpers always order by a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.session import ensure_unique_columns


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct() if cols else df.distinct()


def sort_by_position(df: DataFrame, *positions: int) -> DataFrame:
    """Global sort by output positions (from 1; a negative one descends), NULLs first going up."""
    for position in positions:
        if not 1 <= abs(position) <= len(df.columns):
            raise ValueError(f"no column at position {position}")
    return df.orderBy(*positions)


def top_n(df: DataFrame, n: int, *order_by) -> DataFrame:
    """The first ``n`` rows by the ordering (tied rows at the cut-off are
    picked by the execution unless the ordering is unique)."""
    return df.orderBy(*order_by).limit(n)


def first_row(df: DataFrame, *order_by) -> DataFrame:
    """``first()``/``head()`` made deterministic: the smallest row by the
    ordering. Give enough columns to break ties (a unique key); with ties,
    which tied row comes back is up to the execution."""
    return df.orderBy(*order_by).limit(1)


def max_row(df: DataFrame, *cols: str) -> DataFrame:
    """Fold all rows to the one that is greatest on ``cols`` (lexicographic).

    This is the distributed form of ``reduce((a, b) => max(a, b))``: each task
    folds its rows to one struct, and the partial results are folded again."""
    fields = [f"f{i}" for i in range(len(cols))]
    best = F.max(F.struct(*[F.col(_quoted(c)).alias(f) for c, f in zip(cols, fields)]))
    folded = df.agg(best.alias("best")).filter(F.col("best").isNotNull())   # empty input: no row
    return ensure_unique_columns(
        folded.select(*[F.col("best")[f].alias(c) for c, f in zip(cols, fields)]))


def _quoted(name: str) -> str:
    """A column name (as in ``df.columns``, dots allowed) as an identifier."""
    return "`" + name.replace("`", "``") + "`"
