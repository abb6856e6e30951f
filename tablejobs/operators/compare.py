"""Comparing two tables as multisets, without collecting or joining them.

Every value (and every whole row) is hashed to 128 bits; one table counts up and
the other down, and what is left per hash is the difference. The counts are
combined before the shuffle, so equal values cost one row per task, and a value
that fills a third of a table is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hashes(*columns: Column) -> list[Column]:
    """Two hashes with different seeds, and which of the columns are NULL."""
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(1), *columns).alias("h2"),
            F.concat(*[F.when(c.isNull(), F.lit("-")).otherwise(F.lit("+")) for c in columns]).alias("nulls")]


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per column of ``left``, in order, and one for whole rows (``col_name`` NULL,
    first): ``n_null`` NULLs in ``left``, ``only_left`` and ``only_right`` values that one table
    has more often than the other, counted as often as they are in excess. Both must
    have the same columns and types, in any order; numbers are equal as Spark's hash
    functions see them (-0.0 is 0.0, NaN is NaN). Two empty tables have no rows."""
    if sorted(left.dtypes) != sorted(right.dtypes):
        raise ValueError(f"columns differ: {sorted(set(left.dtypes) ^ set(right.dtypes))}")
    names = left.columns

    def signed(df: DataFrame, sign: int) -> DataFrame:
        columns = [F.col(f"`{n}`") for n in names]
        cells = [F.struct(F.lit(i).alias("c"), (columns[i].isNull() if i >= 0 else F.lit(False)).alias("is_null"),
                          *_hashes(*(columns if i < 0 else [columns[i]]))) for i in range(-1, len(names))]
        return df.select(F.explode(F.array(*cells)).alias("cell"), F.lit(sign).alias("sign")).select("cell.*", "sign")

    both = signed(left, 1).unionByName(signed(right, -1))
    excess = both.groupBy("c", "h1", "h2", "nulls").agg(
        F.sum("sign").alias("d"), F.count_if(F.col("is_null") & (F.col("sign") == 1)).alias("n"))
    name = F.element_at(F.array(F.lit(None).cast("string"), *map(F.lit, names)), F.col("c") + 2)
    return excess.groupBy("c").agg(
        F.sum("n").alias("n_null"), F.sum(F.greatest("d", F.lit(0))).alias("only_left"),
        F.sum(F.greatest(-F.col("d"), F.lit(0))).alias("only_right")) \
        .select(name.alias("col_name"), "n_null", "only_left", "only_right")
