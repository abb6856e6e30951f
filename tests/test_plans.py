"""Physical-plan and job-count assertions: the optimizer does the work."""

import re

import pytest
from pyspark.sql import functions as F

from tablejobs import catalog, jobs
from tablejobs import operators as ops
from tablejobs.plans import count_nodes, exchanges, jobs_started, plan_text
from tablejobs.schemas import LINEITEM_DDL, TABLE_DDL
from tablejobs.session import scratch_path, table_path
from tablejobs.sources import read_csv, read_parquet, require_columns, write_csv


def test_pushdown_of_like_filter(spark, sf_dir):
    plan = plan_text(jobs.filter_like(spark, sf_dir))
    assert "StringContains(p_name,ring)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_filter_on_grouped_output_moves_below_aggregate(spark, sf_dir):
    counts = jobs.group_count(spark, sf_dir)
    plan = plan_text(ops.filter_like(counts, "l_returnflag", "%R%"))
    assert "PushedFilters: [IsNotNull(l_returnflag), StringContains(l_returnflag,R)]" in plan


def test_column_pruning_and_partial_final_aggregate(spark, sf_dir):
    df = jobs.group_count(spark, sf_dir)
    plan = plan_text(df, "simple")
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string>" in plan
    assert "partial_count(1)" in plan
    assert count_nodes(plan, "HashAggregate") == 2
    # hash exchange for the aggregate, range exchange for the global sort
    assert exchanges(df) == 2
    assert "Batched: true" in plan


def test_narrow_steps_pipeline_in_one_codegen_stage(spark, sf_dir):
    df = jobs.select_cols(spark, sf_dir).filter(F.col("l_orderkey") > 10)
    plan = plan_text(df, "simple")
    assert exchanges(df) == 0
    assert set(re.findall(r"\*\((\d+)\)", plan)) == {"1"}


def test_seven_steps_have_one_shuffle(spark, sf_dir):
    staged = jobs.seven_steps_plan(spark, sf_dir)
    assert exchanges(staged) == 1
    plan = plan_text(staged)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)]" in plan


def test_top_n_is_take_ordered(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_text(jobs.top_n(spark, sf_dir), "simple")


def test_coalesce_is_narrow_repartition_is_wide(spark, sf_dir):
    orders = read_parquet(spark, table_path(sf_dir, "orders"))
    assert exchanges(ops.narrow_to(orders, 1)) == 0
    assert "Coalesce" in plan_text(ops.narrow_to(orders, 1), "simple")
    assert exchanges(ops.spread(orders, 4)) == 1
    assert "RoundRobinPartitioning(4)" in plan_text(ops.spread(orders, 4), "simple")
    # coalescing the aggregate output adds no exchange beyond the aggregate's own
    assert exchanges(jobs.repartition_coalesce(spark, sf_dir)) == 1


def test_cache_is_scanned_from_memory(spark, sf_dir):
    counted, totals = jobs.cache_parts(spark, sf_dir)
    plan = plan_text(totals, "simple")
    assert len(re.findall(r"^[^\n]*InMemoryTableScan", plan, re.M)) == 2
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    first = sorted(totals.collect())
    assert sorted(totals.collect()) == first
    counted.unpersist(blocking=True)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before - 1 or before == 0
    assert not counted.storageLevel.useMemory


def test_fd_check_reads_once_and_never_joins(spark, sf_dir):
    plan = plan_text(jobs.fd_check(spark, sf_dir), "simple")
    assert count_nodes(plan, "FileScan") == 1
    assert "Join" not in plan and "BroadcastExchange" not in plan


def test_reduce_row_has_no_sort(spark, sf_dir):
    plan = plan_text(jobs.reduce_row(spark, sf_dir), "simple")
    assert "Sort " not in plan and "TakeOrdered" not in plan
    assert "partial_max" in plan


@pytest.mark.parametrize("declared", [False, True])
def test_parquet_schema_jobs(spark, sf_dir, declared):
    path = table_path(sf_dir, "lineitem")
    n, _ = jobs_started(spark, lambda: read_parquet(spark, path, LINEITEM_DDL if declared else None))
    assert n == (0 if declared else 1)


def test_csv_schema_jobs(spark, sf_dir):
    path = scratch_path(spark, "nation_jobs_csv")
    write_csv(read_parquet(spark, table_path(sf_dir, "nation")), path, "overwrite")
    n_infer, _ = jobs_started(spark, lambda: read_csv(spark, path, header=True, infer_schema=True))
    n_declared, _ = jobs_started(spark, lambda: read_csv(
        spark, path, header=True, schema="n_nationkey INT, n_name STRING, n_regionkey INT"))
    assert (n_infer, n_declared) == (2, 0)


def test_views_and_tables_cost_no_job(spark, sf_dir):
    orders = read_parquet(spark, table_path(sf_dir, "orders"), "o_orderkey BIGINT")
    orders.createOrReplaceTempView("orders_keys")
    n_view, _ = jobs_started(spark, lambda: catalog.view_from_sql(
        spark, "orders_big", "SELECT * FROM orders_keys WHERE o_orderkey > 100"))
    assert n_view == 0
    n_table, _ = jobs_started(spark, lambda: spark.table("orders_keys"))
    assert n_table == 0


def test_rerun_skips_shuffle_stages(spark, sf_dir):
    df = jobs.group_count(spark, sf_dir)
    first, _ = jobs_started(spark, df.collect)
    again, _ = jobs_started(spark, df.collect)
    assert again < first


@pytest.mark.parametrize("name, build, wide", [
    ("filter", lambda o: o.filter(F.col("o_totalprice") > 100), False),
    ("drop", lambda o: ops.drop_cols(o, "o_orderpriority"), False),
    ("rename", lambda o: ops.rename(o, {"o_totalprice": "price"}).filter(F.col("price") > 1), False),
    ("coalesce", lambda o: ops.narrow_to(o, 2), False),
    ("distinct", lambda o: ops.distinct_rows(o, "o_orderstatus"), True),
    ("groupBy.sum", lambda o: ops.group_sum(o, "o_orderstatus", "o_totalprice"), True),
    ("repartition", lambda o: ops.spread(o, 4), True),
])
def test_narrow_and_wide_transformations(spark, sf_dir, name, build, wide):
    orders = read_parquet(spark, table_path(sf_dir, "orders"))
    assert (exchanges(build(orders)) == 1) == wide, name


# Jobs that neither write files nor infer a schema: defining them is free.
READ_ONLY_JOBS = [
    "group_count", "group_count_one", "view_counts_coded", "view_counts_spec", "group_sum",
    "row_count", "distinct_count", "unit_stats", "filter_post_agg", "select_cols", "filter_eq",
    "filter_like", "drop_cols", "derive_cols", "convert_units", "distinct_rows", "top_n",
    "first_row", "reduce_row", "fd_check", "fd_pass", "fd_violations", "repartition_rows", "repartition_coalesce",
    "shuffle_reuse", "partition_profile", "parquet_struct", "parquet_ddl", "view_from_df",
    "view_from_sql", "sql_params",
]


@pytest.mark.parametrize("key", READ_ONLY_JOBS)
def test_defining_a_read_only_job_starts_no_job(spark, sf_dir, key):
    n, _ = jobs_started(spark, lambda: jobs.JOBS[key](spark, sf_dir))
    assert n == 0


@pytest.mark.parametrize("table", sorted(TABLE_DDL))
def test_declared_schemas_equal_stored_ones(spark, sf_dir, table):
    path = table_path(sf_dir, table)
    declared = require_columns(spark, path, TABLE_DDL[table]).schema
    stored = read_parquet(spark, path).schema
    assert [(f.name, f.dataType) for f in declared.fields] == [
        (f.name, f.dataType) for f in stored.fields]


def test_checkpoint_cuts_lineage(spark, sf_dir):
    orders = read_parquet(spark, table_path(sf_dir, "orders"))
    finished = ops.checkpointed(ops.filter_eq(orders, "o_orderstatus", "F"))
    plan = plan_text(finished.groupBy("o_orderpriority").count(), "simple")
    assert "FileScan" not in plan and "ExistingRDD" in plan
    assert finished.count() == orders.filter(F.col("o_orderstatus") == "F").count()
