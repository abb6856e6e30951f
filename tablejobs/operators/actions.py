"""Result delivery (actions) and user functions over rows or partitions.

Large results are written out (``sources.write_files``), not collected. User
functions run on executors; per-partition work gets Arrow batches
(``mapInArrow``) and only small per-batch summaries travel on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def iterate_rows(df: DataFrame, prefetch: bool = False) -> Iterator[Row]:
    """Rows partition by partition; the driver holds one partition at a time."""
    return df.toLocalIterator(prefetchPartitions=prefetch)


def foreach_count(df: DataFrame, predicate: Callable[[Row], bool]) -> int:
    """Run a user function on every row on the executors (``foreach``) and
    count the rows it accepts with an accumulator."""
    acc = df.sparkSession.sparkContext.accumulator(0)

    def visit(row):
        if predicate(row):
            acc.add(1)

    df.foreach(visit)
    return acc.value


def foreach_partition_count(df: DataFrame, fn: Callable[[Iterator[Row]], int]) -> int:
    """Run ``fn`` once per partition on the executors (``foreachPartition``);
    each call returns an integer that an accumulator adds up."""
    acc = df.sparkSession.sparkContext.accumulator(0)

    def visit(rows):
        acc.add(int(fn(rows)))

    df.foreachPartition(visit)
    return acc.value


def fold_rows(df: DataFrame, fn: Callable[[Row, Row], Row], depth: int = 2) -> Row | None:
    """``reduce(f)`` for an arbitrary associative, commutative binary function.

    Each partition folds its own rows; the partial results are merged in a
    tree of ``depth`` levels, so neither one task nor the driver receives more
    than a handful of partial rows. Use ``operators.max_row`` when the fold is
    a maximum: it stays in the JVM."""
    def step(acc, row):
        return (True, fn(acc[1], row) if acc[0] else row)

    def merge(a, b):
        if not a[0]:
            return b
        if not b[0]:
            return a
        return (True, fn(a[1], b[1]))

    has_value, value = df.rdd.treeAggregate((False, None), step, merge, depth)
    return value if has_value else None


def partition_profile(df: DataFrame, profile: Callable[[pa.RecordBatch], dict[str, int]],
                      names: list[str]) -> DataFrame:
    """Apply ``profile`` to every Arrow batch of every partition and add the
    per-batch integer summaries up to one row (``foreachPartition`` with a
    result). Project ``df`` to the columns ``profile`` needs before calling."""
    schema = StructType([StructField(n, LongType(), False) for n in names])

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = dict.fromkeys(names, 0)
        for batch in batches:
            for key, value in profile(batch).items():
                totals[key] += int(value)
        yield pa.RecordBatch.from_pydict({k: pa.array([v], pa.int64()) for k, v in totals.items()})

    parts = df.mapInArrow(per_partition, schema)
    return parts.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names])
