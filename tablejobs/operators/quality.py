"""Consistency (functional dependency) check: does ``key`` determine ``attrs``?

The check passes when the number of distinct keys equals the number of
distinct (key, attrs) combinations. Both numbers come from one scan: the
distinct combinations are found once (partial dedup per task, one Exchange),
counted per key (partial counts, a second Exchange), and the per-key counts
are folded into a single row. NULL keys and NULL attributes are values like
any other (``distinct`` semantics), no group is ever materialised, and the
driver only receives the final row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.session import ensure_unique_columns


def combos_per_key(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """One row per key with the number of distinct attribute combinations."""
    return ensure_unique_columns(df.select(key, *attrs).distinct()
                                 .groupBy(key).agg(F.count(F.lit(1)).alias("n_combos")))


def fd_summary(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Single row: n_keys, n_combos. Equal numbers mean the check passes."""
    per_key = combos_per_key(df, key, attrs)
    return per_key.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum("n_combos"), F.lit(0)).cast("bigint").alias("n_combos"),
    )


def fd_holds(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """fd_summary plus a boolean ``consistent`` column."""
    return fd_summary(df, key, attrs).withColumn(
        "consistent", F.col("n_keys") == F.col("n_combos"))


def fd_violations(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Keys that map to more than one combination, with how many."""
    return combos_per_key(df, key, attrs).filter(F.col("n_combos") > 1)
