"""Schema audit by footers, part files by rows, appends and inferred JSON."""

import os

import pytest
from pyspark.sql import functions as F

from tablejobs import catalog, jobs
from tablejobs.plans import jobs_started
from tablejobs.schemas import EVENTS_DDL, ORDERS_DDL, TABLE_DDL
from tablejobs.session import scratch_path, table_path
from tablejobs.sources import (
    conform, footers, part_files, read_json, read_parquet, require_columns, schema_audit, schema_offences,
    write_files, write_numbered,
)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _two_schemas(spark):
    path = scratch_path(spark, "audit")
    write_files(spark.range(0, 50, numPartitions=3).selectExpr("id AS k", "'x' AS s"), path)
    write_files(spark.range(0, 7, numPartitions=1).selectExpr("CAST(id AS INT) AS k", "id AS extra"), path,
                mode="append")
    return path


def test_counts_per_column_and_type(spark):
    path = _two_schemas(spark)
    assert _rows(schema_audit(spark, path)) == sorted(
        [("k", "bigint", 3, 50, False), ("k", "int", 1, 7, False), ("s", "string", 3, 50, False),
         ("extra", "bigint", 1, 7, False)], key=repr)
    per_file = footers(spark, path)
    assert per_file.select("path").distinct().count() == 4 and per_file.count() == 8


def test_one_odd_file_is_found_where_one_footer_is_not_enough(spark):
    path = _two_schemas(spark)
    with pytest.raises(ValueError, match="all files"):
        require_columns(spark, path, "k BIGINT, s STRING", every_file=True)
    assert _rows(schema_offences(spark, path, "K BIGINT, s STRING")) == sorted(
        [("K", "bigint", "int", 1), ("s", "string", None, 1)], key=repr)
    clean = scratch_path(spark, "audit_clean")
    write_files(spark.range(0, 50, numPartitions=3).selectExpr("id AS k", "'x' AS s"), clean)
    assert require_columns(spark, clean, "s STRING, k BIGINT", every_file=True).count() == 50
    assert schema_offences(spark, clean, "k BIGINT").count() == 0


def test_odd_folders(spark):
    path = _two_schemas(spark)
    local = path.removeprefix("file:")
    with open(os.path.join(local, "part-00009-broken.parquet"), "wb") as out:
        out.write(b"not a parquet file at all")
    audit = {(r["col_name"], r["data_type"]): r["n_files"] for r in schema_audit(spark, path).collect()}
    assert audit[None, "not parquet"] == 1 and audit["k", "bigint"] == 3
    assert (None, None, "not parquet", 1) in _rows(schema_offences(spark, path, "k BIGINT"))
    empty = scratch_path(spark, "audit_empty")
    os.makedirs(empty.removeprefix("file:"))
    assert schema_audit(spark, empty).collect() == []


@pytest.mark.parametrize("table", ["orders", "events"])
def test_types_of_files_spark_did_not_write(spark, sf_dir, table):
    """The supplied files carry no Spark schema: types come from the stored ones."""
    audit = schema_audit(spark, table_path(sf_dir, table))
    n = read_parquet(spark, table_path(sf_dir, table), TABLE_DDL[table]).count()
    stored = read_parquet(spark, table_path(sf_dir, table))
    assert _rows(audit.select("col_name", "data_type", "n_rows", "every_file")) == sorted(
        [(c, kind, n, True) for c, kind in stored.dtypes], key=repr)


def test_all_spark_types_keep_their_names(spark):
    df = spark.sql("SELECT 1Y b, 2S s, 3 i, 4L l, 1.5f f, 2.5D d, 1.23BD dec, 'x' st, true bo, X'00' bi, "
                   "DATE'2020-01-01' da, TIMESTAMP'2020-01-01 00:00:00' ts, TIMESTAMP_NTZ'2020-01-01 00:00:00' tn, "
                   "array(1) a, map('k', 1) m, named_struct('x', 1L) str")
    path = scratch_path(spark, "audit_types")
    write_files(df, path)
    assert {(r["col_name"], r["data_type"]) for r in schema_audit(spark, path).collect()} == set(df.dtypes)


def test_part_file_rows(spark):
    df = spark.range(100).withColumn("s", F.lit("x"))
    files = write_numbered(df, scratch_path(spark, "numbered"), F.col("id") % 7, 7)
    assert [(r["task"], r["n_rows"]) for r in files.orderBy("task").collect()] == [
        (t, len(range(t, 100, 7))) for t in range(7)]
    assert files.filter("size <= 0 OR size <> read_size").count() == 0
    path = scratch_path(spark, "unused_tasks")          # only task 5 has rows; task 0 leaves the schema
    files = write_numbered(df, path, F.lit(5), 9)
    assert [(r["task"], r["n_rows"]) for r in files.orderBy("task").collect()] == [(0, 0), (5, 100)]
    assert files.filter("n_rows = 0").first()["read_size"] is None


def test_file_rows_are_the_tables(spark, sf_dir):
    files = jobs.file_rows(spark, sf_dir)
    orders = read_parquet(spark, table_path(sf_dir, "orders"), ORDERS_DDL)
    assert files.agg(F.sum("n_rows")).first()[0] == orders.count()


def test_append_is_seen_after_a_read_and_a_path_append_is_not(spark, sf_dir):
    supplier = read_parquet(spark, table_path(sf_dir, "supplier"), TABLE_DDL["supplier"])
    path, table = scratch_path(spark, "stale"), f"{catalog.new_database(spark, 'stale')}.s"
    n = catalog.save_external(supplier, table, path).count()
    moved = supplier.select(*reversed(supplier.columns))
    assert catalog.append_to_table(moved, table).count() == 2 * n
    assert spark.table(table).distinct().count() == n
    write_files(supplier, path, "parquet", "append")    # behind the catalog's back
    assert spark.table(table).count() == 2 * n and catalog.refresh(spark, table).count() == 3 * n


def test_json_inference_is_one_job_and_conforms(spark, sf_dir):
    events = read_parquet(spark, table_path(sf_dir, "events"), EVENTS_DDL)
    path = scratch_path(spark, "infer_json")
    write_files(events, path, "json")
    started, inferred = jobs_started(spark, lambda: read_json(spark, path))
    assert started == 1 and jobs_started(spark, lambda: read_json(spark, path, EVENTS_DDL))[0] == 0
    assert inferred.columns == sorted(events.columns) and dict(inferred.dtypes)["ts"] == "string"
    back = conform(inferred, EVENTS_DDL)
    assert back.dtypes == events.dtypes
    assert back.exceptAll(events).count() == 0 and events.exceptAll(back).count() == 0


def test_conform_names_and_missing_columns(spark):
    df = spark.createDataFrame([("1", 2.0, "z")], "B STRING, `a.x` DOUBLE, c STRING")
    out = conform(df, "`a.x` INT, b BIGINT, gone DATE")
    assert out.dtypes == [("a.x", "int"), ("b", "bigint"), ("gone", "date")]
    assert tuple(out.first()) == (2, 1, None)
