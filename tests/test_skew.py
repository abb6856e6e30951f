"""Hot keys, measured: one key holds a third of all rows. Task metrics from the
event log show that the hot third never crosses the network row by row and
never lands in one reduce task, because every aggregate combines on the map
side before its shuffle."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tablejobs import operators as ops
from tablejobs.plans import job_ids_of
from tablejobs.plans.eventlog import event_log_path, stages_of_jobs, task_records
from tablejobs.session import table_path
from tablejobs.sources import read_parquet

MAP_TASKS = 16


@pytest.fixture(scope="module")
def skewed(spark, sf_dir):
    """lineitem over 16 map partitions, keyed by supplier, except that every
    third order (a third of all rows) is relabelled to the hot key -1."""
    lineitem = read_parquet(spark, table_path(sf_dir, "lineitem"))
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_suppkey"))
    df = (lineitem.select(hot.alias("k"), "l_partkey", "l_suppkey")
          .repartition(MAP_TASKS).cache())
    n = df.count()
    n_hot = df.filter(F.col("k") == -1).count()
    n_keys = df.select("k").distinct().count()
    assert n_hot * 4 > n          # the hot key really holds about a third
    return df, n, n_hot, n_keys


@contextlib.contextmanager
def _uncoalesced(spark):
    """Keep every reduce partition its own task while measuring (AQE would
    otherwise merge tiny partitions and blur the per-task numbers)."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _shuffle_metrics(spark, action):
    """(records written by map tasks, most records read by one task, result)."""
    with _uncoalesced(spark):
        ids, result = job_ids_of(spark, action)     # waits for the listener bus
    path = event_log_path(spark)
    assert path, "event log is not enabled in the test session"
    tasks = task_records(path, stages_of_jobs(spark, ids))
    written = sum(t.shuffle_records_written for t in tasks)
    worst = max((t.shuffle_records_read for t in tasks), default=0)
    return written, worst, result


def test_group_count_hot_key_is_combined(spark, skewed):
    df, n, n_hot, n_keys = skewed
    written, worst, rows = _shuffle_metrics(
        spark, lambda: ops.group_count(df, "k", order=False).collect())
    assert {r["k"]: r["counts"] for r in rows}[-1] == n_hot
    # each map task sends at most one partial row per key it saw
    assert written <= MAP_TASKS * n_keys < n // 4
    assert worst < n_hot // 10


def test_consistency_check_hot_key_is_combined(spark, skewed):
    df, n, n_hot, n_keys = skewed
    written, worst, rows = _shuffle_metrics(
        spark, lambda: ops.fd_summary(df, "k", ["l_partkey"]).collect())
    assert rows[0]["n_keys"] == n_keys
    # distinct (key, attr) pairs spread over reducers; the per-key count is
    # combined again before its own shuffle
    assert worst < n_hot // 2


def test_measurement_sees_a_raw_shuffle(spark, skewed):
    """Control: hashing raw rows by the hot key puts the whole third in one task."""
    df, n, n_hot, n_keys = skewed
    written, worst, _ = _shuffle_metrics(
        spark, lambda: df.repartition(8, "k").write.format("noop").mode("overwrite").save())
    assert written == n
    assert worst >= n_hot
