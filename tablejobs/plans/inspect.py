"""Plan and job inspection: what Spark will run, and how many jobs it took.

Used by tests to assert the physical shape of a job (pushed filters, pruned
read schema, number of Exchanges, codegen spans, cache scans) and by users to
check laziness: how many jobs a read, a view definition or an action starts.
"""

from __future__ import annotations

import contextlib
import re
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablejobs.plans.eventlog import settle


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, returned instead of printed."""
    jdf = df._jdf
    return jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def executed_plan(df: DataFrame) -> str:
    """Physical plan after AQE has finalised it (requires the df to have run)."""
    return str(df._jdf.queryExecution().executedPlan().toString())


def count_nodes(plan: str, node: str) -> int:
    """How many lines of a plan start a node with the given name."""
    return len(re.findall(rf"(?m)^[\s\-+:*()0-9]*{re.escape(node)}\b", plan))


def exchanges(df: DataFrame) -> int:
    return count_nodes(plan_text(df, "simple"), "Exchange")


def job_ids_of(spark: SparkSession, action: Callable[[], object]) -> tuple[list[int], object]:
    """Run ``action`` in a job group of its own; return (its job ids, result)."""
    sc = spark.sparkContext
    keys = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    before = {k: sc.getLocalProperty(k) for k in keys}
    group = f"tj-{uuid.uuid4().hex}"
    sc.setJobGroup(group, "tablejobs job count")
    try:
        result = action()
    finally:
        for key, value in before.items():    # give the caller's job group back
            with contextlib.suppress(Exception):
                sc.setLocalProperty(key, value)
    if not settle(spark):                    # the status store fills asynchronously
        warnings.warn("Spark's listener bus did not drain; the job list may be incomplete",
                      RuntimeWarning, stacklevel=2)
    return list(sc.statusTracker().getJobIdsForGroup(group)), result


def jobs_started(spark: SparkSession, action: Callable[[], object]) -> tuple[int, object]:
    """Run ``action`` in a job group of its own; return (jobs started, result)."""
    ids, result = job_ids_of(spark, action)
    return len(ids), result
