"""An arbitrary reduce in distributed rounds, against a plain left fold."""

import functools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablejobs import jobs
from tablejobs import operators as ops
from tablejobs.plans import plan_text


def compose(f, g):
    """Affine maps x -> a x + b one after the other, modulo a prime: associative, not commutative."""
    return f[0] * g[0] % 10007, (g[0] * f[1] + g[1]) % 10007


def _maps(spark, n, parts):
    ids = spark.range(0, n, numPartitions=parts)
    return ids.select((F.col("id") % 91 + 2).alias("a"), (F.col("id") % 83).alias("b"))


@pytest.mark.parametrize("parts, fan_in", [(1, 32), (7, 2), (7, 3), (40, 3), (40, 32)])
def test_rows_meet_in_order_whatever_the_rounds(spark, parts, fan_in):
    df = _maps(spark, 1000, parts)
    expected = functools.reduce(compose, [(i % 91 + 2, i % 83) for i in range(1000)])
    assert [tuple(r) for r in ops.fold_any(df, compose, fan_in=fan_in).collect()] == [expected]


def test_empty_partitions_and_empty_input(spark):
    df = _maps(spark, 5, 16)                            # most tasks have no row
    expected = functools.reduce(compose, [(i + 2, i) for i in range(5)])
    assert [tuple(r) for r in ops.fold_any(df, compose, fan_in=2).collect()] == [expected]
    assert ops.fold_any(df.limit(0), compose).collect() == []
    assert ops.fold_any(df.filter("a > 5 and a < 7"), compose).collect()[0]["b"] == 4


def test_batches_are_folded_at_once(spark):
    df = spark.range(0, 3000, numPartitions=5).select(F.col("id").alias("x"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        xor = ops.fold_any(df, lambda a, b: (a[0] ^ b[0],),
                           lambda batch: (int(np.bitwise_xor.reduce(np.asarray(batch.column(0)))),))
        assert xor.collect()[0][0] == functools.reduce(int.__xor__, range(3000))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_values_of_all_kinds_and_nulls_pass(spark):
    rows = [(None, "a", 1.5, None), (2, None, None, b"x"), (3, "c", 2.5, b"yy")]
    df = spark.createDataFrame(rows, "n long, s string, d double, b binary").coalesce(1)

    def longest(a, b):
        return max((a, b), key=lambda r: (len(r[3] or b""), r[0] or 0))

    assert [tuple(r) for r in ops.fold_any(df, longest).collect()] == [rows[2]]
    assert tuple(ops.fold_any(df.limit(1), longest).collect()[0]) == rows[0]


def test_user_errors_come_through(spark):
    with pytest.raises(Exception, match="no such fold"):
        def bad(a, b):
            raise ValueError("no such fold")
        ops.fold_any(_maps(spark, 10, 2), bad).collect()
    with pytest.raises(ValueError):
        ops.fold_any(_maps(spark, 10, 2), compose, fan_in=1)


def test_the_scan_runs_once_and_partials_are_read(spark, sf_dir):
    plan = plan_text(jobs.fold_any(spark, sf_dir), "simple")
    assert "l_orderkey" not in plan and plan.count("FileScan") == 1 and "__task" in plan
