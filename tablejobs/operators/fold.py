"""``reduce(f)`` for any f, as a fold in several distributed levels.

Each task folds its own rows into one partial row; partials are then merged in
rounds, at most ``fan_in`` neighbours at a time, each round by as many tasks as
there are groups. No task and no driver ever holds more than ``fan_in`` partial
rows, however many tasks the input has. Rows meet in the order of partitions and
of rows inside them, so ``merge`` has to be associative but need not commute.

``operators.max_row`` and the built-in aggregates stay in the JVM: use them where
they express the fold. This one is for functions that Spark has no aggregate for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructType

from tablejobs.session import scratch_path
from tablejobs.sources.readers import read_parquet
from tablejobs.sources.writers import write_files

#: Partial rows merged at once.
FAN_IN = 32
_TASK, _GROUP = "__task", "__group"


def fold_any(df: DataFrame, merge: Callable[[tuple, tuple], tuple],
             fold_batch: Callable[[pa.RecordBatch], tuple] | None = None,
             fan_in: int = FAN_IN) -> DataFrame:
    """One row with the columns of ``df``: all rows folded by ``merge``, which takes
    two rows as tuples and returns one. No row when ``df`` has none.

    ``fold_batch`` folds a non-empty Arrow batch at once (vectorised); without it the
    rows of a batch are merged one by one. The partials are saved in the shared folder
    before they are merged: a lost executor costs its own tasks, never the scan again."""
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    spark, schema = df.sparkSession, df.schema
    with_task = StructType([*schema.fields]).add(_TASK, LongType())
    arrow = to_arrow_schema(with_task)

    def one_row(row: tuple, task: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], kind) for v, kind in zip((*row, task), arrow.types)], schema=arrow)

    def fold_rows(rows: Iterator[tuple], start=None):
        for row in rows:
            start = row if start is None else merge(start, row)
        return start

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if fold_batch is not None:
                row = tuple(fold_batch(batch))
                folded = row if folded is None else merge(folded, row)
            else:
                folded = fold_rows(zip(*[c.to_pylist() for c in batch.columns]), folded)
        if folded is not None:
            yield one_row(folded, TaskContext.get().partitionId())

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, folded = None, None
        for batch in batches:
            for *row, _, own in zip(*[c.to_pylist() for c in batch.columns]):
                if own != group and folded is not None:
                    yield one_row(folded, group)
                folded = tuple(row) if own != group else merge(folded, tuple(row))
                group = own
        if folded is not None:
            yield one_row(folded, group)

    path = scratch_path(spark, "fold_partials")
    write_files(df.mapInArrow(partials, with_task), path, "parquet")
    level = read_parquet(spark, path, with_task)
    last = level.agg(F.max(_TASK)).first()[0] or 0      # a number, not the partials
    while True:
        groups = last // fan_in + 1
        level = (level.withColumn(_GROUP, F.floor(F.col(_TASK) / fan_in))
                 .repartition(groups, _GROUP).sortWithinPartitions(_GROUP, _TASK)
                 .mapInArrow(merged, with_task))
        if groups == 1:
            return level.drop(_TASK)
        last = groups - 1
