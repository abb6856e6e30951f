"""Every registered job's physical plan passes the scale checks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablejobs.jobs import JOBS as QUERIES
from tablejobs.jobs import UNORDERED_LIMIT_JOBS as UNORDERED_LIMIT_OK
from tablejobs.jobs import WRITE_PLANS
from tablejobs.plans import lint_plan


PYTHON_JOBS = ("partition_profile", "fold_any", "schema_audit")
#: Exchanges of what the writing jobs run before they read back; the others scan and write.
#: (The cached counts' one is printed below each of their two consumers.)
WRITE_EXCHANGES = {"seven_steps": 1, "sink_aggregate": 1, "checkpoint_reuse": 1, "cache_reuse": 4, "file_rows": 1}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_scales(spark, sf_dir, key):
    report = lint_plan(QUERIES[key](spark, sf_dir),
                       allow_unordered_limit=key in UNORDERED_LIMIT_OK)
    assert report.ok, report.problems
    # the only Python in any plan: the Arrow-batched per-partition profile, a round of the
    # arbitrary fold, and the reading of footers
    assert report.python_nodes == (["MapInArrow"] if key in PYTHON_JOBS else [])


@pytest.mark.parametrize("key", sorted(WRITE_PLANS))
def test_what_writing_jobs_run_scales(spark, sf_dir, key):
    """The DataFrame a writing job returns is a read-back; this is what it wrote."""
    report = lint_plan(WRITE_PLANS[key](spark, sf_dir))
    assert report.ok, report.problems
    assert report.exchanges == WRITE_EXCHANGES.get(key, 0)


def test_every_writing_job_has_its_plan(spark, sf_dir):
    from tests.test_plans import READ_ONLY_JOBS

    assert set(WRITE_PLANS) == set(QUERIES) - set(READ_ONLY_JOBS) - {"parquet_inferred"}


def test_lint_catches_raw_shuffles_and_broadcasts(spark, sf_dir):
    a = spark.range(100).withColumn("k", F.col("id") % 7)
    b = spark.range(10).withColumnRenamed("id", "k")
    joined = a.join(F.broadcast(b), "k")
    assert any("BroadcastExchange" in p for p in lint_plan(joined).problems)
    windowed = a.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")))
    assert any("hash shuffle of raw rows" in p for p in lint_plan(windowed).problems)
    assert any("without an ordering" in p for p in lint_plan(a.limit(5)).problems)
    assert lint_plan(a.groupBy("k").count()).ok
