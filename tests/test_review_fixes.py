"""Regression tests for behaviours found in review."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tablejobs import catalog
from tablejobs import operators as ops
from tablejobs.operators.actions import fold_rows
from tablejobs.plans import jobs_started, lint_plan
from tablejobs.session import release, scratch_path, scratch_root, table_path
from tablejobs.sources import (
    raw_preview,
    read_csv,
    read_json,
    read_parquet,
    write_csv,
    write_files,
    write_with_inventory,
)


def test_append_to_table_matches_columns_by_name(spark):
    db = catalog.new_database(spark, "append")
    first = spark.createDataFrame([("a1", "b1")], "a STRING, b STRING")
    catalog.save_managed(first, f"{db}.t")
    swapped = spark.createDataFrame([("b2", "a2")], "b STRING, a STRING")
    rows = {tuple(r) for r in catalog.append_to_table(swapped, f"{db}.t").collect()}
    assert rows == {("a1", "b1"), ("a2", "b2")}


@pytest.mark.parametrize("shape", ["empty_first_partition", "all_empty", "plain"])
def test_write_inventory_counts_the_task0_file(spark, shape):
    base = spark.range(0, 1000, numPartitions=4)
    df = {"empty_first_partition": base.filter(F.spark_partition_id() != 0),
          "all_empty": base.filter(F.col("id") < 0),
          "plain": base}[shape]
    row = write_with_inventory(df, scratch_path(spark, f"inv_{shape}")).first()
    assert row["files_match"] is True
    assert row["n_rows"] == df.count()


def test_text_reads_accept_other_timestamp_spellings(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tj-ts-"), "ts.csv")
    with open(path, "w") as fh:
        fh.write("id,ts\n1,2024-01-01 10:00:00\n2,2024-01-01T10:00:00\n")
    got = [r["ts"] for r in read_csv(spark, path, schema="id INT, ts TIMESTAMP_NTZ").collect()]
    assert got == [dt.datetime(2024, 1, 1, 10, 0)] * 2


@pytest.mark.parametrize("ts_type", ["TIMESTAMP", "TIMESTAMP_NTZ"])
@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_roundtrip_keeps_microseconds_for_both_timestamp_types(spark, ts_type, fmt):
    ddl = f"id INT, ts {ts_type}"
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0, 0, 123456))], ddl)
    path = scratch_path(spark, f"ts_{fmt}")
    if fmt == "csv":
        write_csv(df, path)
        back = read_csv(spark, path, schema=ddl)
    else:
        write_files(df, path, "json")
        back = read_json(spark, path, ddl)
    assert back.first()["ts"] == df.first()["ts"]


def test_describe_summary_lists_partition_columns_once(spark):
    db = catalog.new_database(spark, "part")
    location = scratch_path(spark, "partitioned")
    spark.sql(f"CREATE TABLE {db}.p (id INT, k INT) USING parquet PARTITIONED BY (k) "
              f"LOCATION '{location}'")
    rows = [tuple(r) for r in catalog.describe_summary(spark, f"{db}.p").collect()]
    assert rows == [("id", "int"), ("k", "int"), ("Type", "EXTERNAL"), ("Provider", "parquet")]


def test_release_refuses_the_scratch_area_itself(spark):
    from tablejobs.session import session_scratch
    base = session_scratch(spark)
    for bad in (base, base + "/", base + "//", base + "/x/../.."):
        with pytest.raises(ValueError):
            release(spark, bad)


def test_raw_preview_of_a_multi_file_write_is_one_files_head(spark, sf_dir):
    path = scratch_path(spark, "preview_multi")
    customer = read_parquet(spark, table_path(sf_dir, "customer"))
    write_csv(ops.spread(customer, 4), path)
    lines = [r["value"] for r in raw_preview(spark, path, 20).collect()]
    assert len(lines) == 20
    assert lines[0].startswith("c_custkey") and not any(ln.startswith("c_custkey") for ln in lines[1:])


def test_lint_flags_a_limit_over_a_partition_local_sort(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    assert not lint_plan(df.sortWithinPartitions("k").limit(5)).ok
    assert lint_plan(df.orderBy("k").limit(5)).ok


def test_fold_rows_of_empty_input_is_none_in_one_pass(spark):
    assert fold_rows(spark.range(0), lambda a, b: a) is None
    assert fold_rows(spark.range(5), lambda a, b: a if a[0] > b[0] else b)[0] == 4


def test_release_refuses_dot_components(spark):
    from tablejobs.session import session_scratch
    base = session_scratch(spark)
    for bad in (base + "/.", base + "/./", base + "/x/.", base + "/./x"):
        with pytest.raises(ValueError):
            release(spark, bad)


def test_fold_rows_lets_user_errors_through(spark):
    def bad(a, b):
        return max([])                      # raises ValueError mentioning "empty"
    with pytest.raises(Exception, match="empty"):
        fold_rows(spark.range(0, 4, numPartitions=4), bad)


def test_append_by_name_handles_dotted_names_and_rejects_extra_columns(spark):
    db = catalog.new_database(spark, "append2")
    catalog.save_managed(spark.createDataFrame([("a1", "d1")], "a STRING, `x.y` STRING"),
                         f"{db}.t")
    moved = spark.createDataFrame([("d2", "a2")], "`x.y` STRING, a STRING")
    rows = {tuple(r) for r in catalog.append_to_table(moved, f"{db}.t").collect()}
    assert rows == {("a1", "d1"), ("a2", "d2")}
    extra = spark.createDataFrame([("a3", "d3", "e3")], "a STRING, `x.y` STRING, e STRING")
    with pytest.raises(Exception):
        catalog.append_to_table(extra, f"{db}.t")


def test_raw_preview_accepts_globs_and_partition_folders(spark, sf_dir):
    path = scratch_path(spark, "preview_glob")
    customer = read_parquet(spark, table_path(sf_dir, "customer"))
    write_csv(customer, path)
    assert len(raw_preview(spark, path + "/*.csv", 5).collect()) == 5
    parted = scratch_path(spark, "preview_parted")
    customer.write.partitionBy("c_mktsegment").option("header", True).csv(parted)
    assert len(raw_preview(spark, parted, 5).collect()) == 5


def test_describe_summary_odd_column_names_and_defaults(spark):
    db = catalog.new_database(spark, "odd")
    spark.sql(f"CREATE TABLE {db}.d (`#id` INT, Type INT DEFAULT 5) USING parquet")
    rows = [tuple(r) for r in catalog.describe_summary(spark, f"{db}.d").collect()]
    assert rows == [("#id", "int"), ("Type", "int"), ("Type", "MANAGED"), ("Provider", "parquet")]


def test_lint_accepts_deterministic_limits(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    assert lint_plan(df.orderBy("k", "id").limit(10).filter(F.col("k") > 1).limit(5)).ok
    assert lint_plan(df.orderBy("k").filter(F.col("id") > 3).limit(5)).ok
    assert lint_plan(df.coalesce(1).sortWithinPartitions("k").limit(5)).ok
    assert not lint_plan(df.repartition(4).sortWithinPartitions("k").limit(5)).ok


def test_append_refuses_missing_columns(spark):
    db = catalog.new_database(spark, "append3")
    catalog.save_managed(spark.createDataFrame([("a1", "b1")], "a STRING, b STRING"), f"{db}.t")
    with pytest.raises(ValueError, match="missing=\\['b'\\]"):
        catalog.append_to_table(spark.createDataFrame([("a2",)], "a STRING"), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 1


def test_inventory_catches_a_missing_file_and_odd_names(spark):
    from tablejobs.sources import check_inventory
    df = spark.range(0, 1000, numPartitions=4)
    path = scratch_path(spark, "inv_missing")
    assert write_with_inventory(df, path).first()["files_match"] is True
    local = path.removeprefix("file:")
    victim = sorted(f for f in os.listdir(local) if f.startswith("part-00003"))[0]
    os.remove(os.path.join(local, victim))
    assert check_inventory(spark, path, 1000).first()["files_match"] is False

    odd = scratch_path(spark, "inv_odd")
    assert write_with_inventory(df, odd).first()["files_match"] is True
    df.limit(1).coalesce(1).write.parquet(odd + "_tmp")
    tmp_local = (odd + "_tmp").removeprefix("file:")
    extra = [f for f in os.listdir(tmp_local) if f.endswith(".parquet")][0]
    os.rename(os.path.join(tmp_local, extra),
              os.path.join(odd.removeprefix("file:"), "other.snappy.parquet"))
    assert check_inventory(spark, odd).first()["files_match"] is False


def test_raw_preview_of_an_empty_file_is_empty(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tj-empty-"), "empty.csv")
    open(path, "w").close()
    assert raw_preview(spark, path, 5).count() == 0


def test_job_count_keeps_the_callers_job_group(spark):
    from tablejobs.plans import jobs_started
    sc = spark.sparkContext
    sc.setJobGroup("callers-group", "mine")
    try:
        jobs_started(spark, lambda: spark.range(3).count())
        assert sc.getLocalProperty("spark.jobGroup.id") == "callers-group"
        assert sc.getLocalProperty("spark.job.description") == "mine"
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            sc.setLocalProperty(key, None)


def test_scratch_root_refuses_a_driver_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_describe_text_fallback_reads_details(spark):
    db = catalog.new_database(spark, "fallback")
    catalog.save_external(spark.range(3), f"{db}.e", scratch_path(spark, "fallback_e"))
    assert catalog._detail_rows(spark, f"{db}.e", ("Type", "Provider")) == ["EXTERNAL", "parquet"]


def test_append_may_leave_out_columns_with_defaults(spark):
    db = catalog.new_database(spark, "defaults")
    spark.sql(f"CREATE TABLE {db}.d (a STRING, b INT DEFAULT 7) USING parquet")
    rows = catalog.append_to_table(spark.createDataFrame([("x",)], "a STRING"), f"{db}.d")
    assert [tuple(r) for r in rows.collect()] == [("x", 7)]


def test_write_inventory_computes_its_input_once(spark):
    """A row-counting UDF shows the input is evaluated by the write only."""
    from pyspark.sql.functions import udf
    seen = spark.sparkContext.accumulator(0)

    @udf("long")
    def touch(x):
        seen.add(1)
        return x

    df = spark.range(0, 500, numPartitions=3).select(touch("id").alias("id"))
    result = write_with_inventory(df, scratch_path(spark, "inv_once")).first()
    assert result["files_match"] is True and result["n_rows"] == 500
    assert seen.value == 500


def test_inventory_of_a_folder_without_files_is_a_mismatch(spark):
    from tablejobs.sources import check_inventory
    path = scratch_path(spark, "inv_gone")
    write_with_inventory(spark.range(10), path)
    local = path.removeprefix("file:")
    for name in os.listdir(local):
        if name.endswith(".parquet"):
            os.remove(os.path.join(local, name))
    assert tuple(check_inventory(spark, path, 10).first()) == (False, False, 0)


def test_session_folder_is_fixed_per_session(spark):
    from tablejobs.session import session_scratch
    other = spark.newSession()             # RESET only this throwaway session
    first = session_scratch(other)
    other.sql("RESET")
    assert session_scratch(other) == first
    assert session_scratch(spark) != first


def test_release_all_is_per_session(spark):
    from tablejobs.session import release_all, session_scratch
    other = spark.newSession()
    mine = scratch_path(spark, "keep_me")
    theirs = scratch_path(other, "drop_me")
    assert session_scratch(spark) != session_scratch(other)
    write_files(spark.range(3), mine, "parquet")
    write_files(other.range(3), theirs, "parquet")
    db = catalog.new_database(other, "gone")
    catalog.save_managed(other.range(2), f"{db}.t")
    assert release_all(other) is True
    assert read_parquet(spark, mine).count() == 3
    assert not os.path.exists(theirs.removeprefix("file:"))
    assert db not in [d.name for d in spark.catalog.listDatabases()]


@pytest.mark.parametrize("default", ["json", "csv", "JSON",
                                     "org.apache.spark.sql.execution.datasources.json.JsonFileFormat"])
@pytest.mark.parametrize("ts_type", ["TIMESTAMP_NTZ", "TIMESTAMP"])
def test_default_format_writes_keep_microseconds_when_the_default_is_text(spark, default, ts_type):
    session = spark.newSession()
    try:
        session.conf.set("spark.sql.sources.default", default)
        ddl = f"id INT, ts {ts_type}"
        df = session.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0, 0, 123456))], ddl)
        path = scratch_path(session, "default_json_ts")
        write_files(df, path, None)
        assert session.read.schema(ddl).load(path).first()["ts"] == df.first()["ts"]
    finally:
        from tablejobs.session import release_all
        release_all(session)


def test_raw_preview_takes_the_first_file_by_path(spark, sf_dir):
    customer = read_parquet(spark, table_path(sf_dir, "customer"))
    no_task0 = customer.repartition(4).filter(F.spark_partition_id() != 0)
    path = scratch_path(spark, "preview_no_task0")
    write_csv(no_task0, path)
    assert len(raw_preview(spark, path, 20).collect()) == 1          # part-00000: header only
    jobs, _ = jobs_started(spark, lambda: raw_preview(spark, path, 20))
    assert jobs <= 3                          # two listings and the minimum, whatever the files
