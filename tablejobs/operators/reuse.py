"""Partition control and reuse of intermediate results.

``coalesce(n)`` merges partitions without a shuffle (narrow); ``repartition``
redistributes with an Exchange (wide). ``cache`` keeps an intermediate result
(at ``df.cache()``'s level, memory then disk) so later actions skip recomputing it; a lost executor's
cached blocks are rebuilt from lineage; ``held`` releases it after its last
consumer. ``checkpointed`` writes the result to the shared checkpoint folder and
cuts the lineage. Without either, two consumers of one DataFrame in one query
still share its shuffle: Spark runs the Exchange once and reads it twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tablejobs.operators.aggregate import group_sum
from tablejobs.session import scratch_root


def narrow_to(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle (use on small, aggregated output)."""
    return df.coalesce(n)


def spread(df: DataFrame, n: int) -> DataFrame:
    """Redistribute rows to ``n`` partitions, round-robin: no key decides where a
    row goes, so none can be hot."""
    return df.repartition(n)


def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> DataFrame:
    """Persist at the level ``df.cache()`` uses unless told otherwise."""
    return df.persist(level)


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> Iterator[DataFrame]:
    """``df`` cached for the consumers inside the ``with`` block and released when it
    ends, also by an error. Run the consumers' actions inside: a result that is used
    later would fill the cache again."""
    kept = cached(df, level)
    try:
        yield kept
    finally:
        kept.unpersist(blocking=True)


def totals_by_each(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(key, ``value``): the sums of ``value`` by each of ``keys``, one below the other. Every
    key is a consumer of ``counts``, so what ``counts`` costs is paid once if it is cached,
    checkpointed, or ends in an Exchange."""
    totals = [group_sum(counts.withColumnRenamed(k, "key"), "key", value, name=value) for k in keys]
    return reduce(DataFrame.unionByName, totals)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the application's shared checkpoint folder and continue
    from there: the lineage is cut, so a lost executor costs a re-read of the
    checkpoint files instead of a recomputation from the sources. (A local
    checkpoint would keep the data on executors and is never used.) These
    files are Spark's: ``release_all`` does not touch them; Spark removes them
    when ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on."""
    scratch_root(df.sparkSession)          # a shared folder must be set
    return df.checkpoint(eager=True)
