"""One test per trap found between the notebooks' claims and Spark 4 behaviour."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablejobs import catalog
from tablejobs import operators as ops
from tablejobs.schemas import EVENTS_DDL, IRIS_SCHEMA, WEATHER_DDL
from tablejobs.session import scratch_path, table_path
from tablejobs.sources import (
    read_csv,
    read_json,
    read_parquet,
    require_columns,
    write_files,
)
from tests.fixtures import write_iris, write_weather


@pytest.fixture(scope="module")
def folder():
    return tempfile.mkdtemp(prefix="tablejobs-drift-")


def test_v1_parenthesised_names_roundtrip(spark, folder):
    df = spark.range(5).groupBy((F.col("id") % 2).alias("k")).agg(F.count(F.lit(1)))
    assert "count(1)" in df.columns
    out = os.path.join(folder, "v1")
    write_files(df, out, "parquet", "overwrite")
    assert sorted(r["count(1)"] for r in read_parquet(spark, out).collect()) == [2, 3]


def test_v2_wrong_schema_is_caught_early(spark, sf_dir):
    path = table_path(sf_dir, "orders")
    unknown = read_parquet(spark, path, "o_orderkey BIGINT, nope STRING")
    assert unknown.filter(F.col("nope").isNotNull()).count() == 0
    with pytest.raises(ValueError, match="missing=\\['nope'\\]"):
        require_columns(spark, path, "o_orderkey BIGINT, nope STRING")
    with pytest.raises(ValueError, match="o_orderkey: declared string, stored bigint"):
        require_columns(spark, path, "o_orderkey STRING")
    ok = require_columns(spark, path, "O_ORDERKEY BIGINT, o_orderstatus STRING")
    assert ok.count() == read_parquet(spark, path).count()


def test_v3_path_writes_need_refresh_table_writes_do_not(spark, sf_dir, folder):
    db = catalog.new_database(spark, "v3")
    nation = read_parquet(spark, table_path(sf_dir, "nation"))
    path = os.path.join(folder, "v3_nation")
    table = catalog.save_external(nation, f"{db}.nation", path)
    assert table.count() == 25
    write_files(nation, path, "parquet", "append")            # behind the catalog's back
    assert catalog.refresh(spark, f"{db}.nation").count() == 50
    assert catalog.append_to_table(nation, f"{db}.nation").count() == 75


def test_v4_external_and_managed_need_separate_names(spark, sf_dir, folder):
    db = catalog.new_database(spark, "v4")
    nation = read_parquet(spark, table_path(sf_dir, "nation"))
    catalog.save_external(nation, f"{db}.weather", os.path.join(folder, "v4"))
    catalog.save_managed(nation, f"{db}.weather_managed")
    kinds = {r["name"]: r["tableType"] for r in catalog.list_tables(spark, db).collect()
             if not r["isTemporary"]}
    assert kinds == {"weather": "EXTERNAL", "weather_managed": "MANAGED"}


def test_v7_schema_without_header_keeps_header_as_row(spark, folder):
    path = write_iris(os.path.join(folder, "v7"))
    df = read_csv(spark, path, header=False, schema=IRIS_SCHEMA)
    assert df.count() == 24
    header_row = df.filter(F.col("species") == "Species").first()
    assert header_row["sepal_length"] is None and header_row["index"] is None


def test_v8_declared_names_override_header(spark, folder):
    path = write_iris(os.path.join(folder, "v8"))
    df = read_csv(spark, path, header=True, schema=IRIS_SCHEMA)
    assert df.columns[1] == "sepal_length"
    strict = read_csv(spark, path, header=True, schema=IRIS_SCHEMA, enforceSchema=False)
    with pytest.raises(Exception):
        strict.collect()


def test_v9_database_is_flattened(spark, sf_dir):
    db = catalog.new_database(spark, "v9")
    catalog.save_managed(read_parquet(spark, table_path(sf_dir, "region")), f"{db}.region")
    row = catalog.list_tables(spark, db, "region").first()
    assert (row["name"], row["database"], row["isTemporary"]) == ("region", db, False)


def test_v12_null_tuples_count_once(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, None)], "k INT, v STRING")
    assert ops.distinct_count(df, "k", "v").first()["n"] == 3
    assert df.agg(F.countDistinct("k", "v")).first()[0] == 1
    summary = ops.fd_summary(df, "k", ["v"]).first()
    assert (summary["n_keys"], summary["n_combos"]) == (3, 3)


def test_v14_output_is_part_files_and_success_marker(spark, sf_dir, folder):
    out = os.path.join(folder, "v14")
    write_files(read_parquet(spark, table_path(sf_dir, "nation")).coalesce(1), out,
                "parquet", "overwrite")
    names = sorted(os.listdir(out))
    assert "_SUCCESS" in names
    assert [n for n in names if n.endswith(".snappy.parquet")]


def test_v15_text_formats_keep_microseconds(spark, sf_dir):
    events = read_parquet(spark, table_path(sf_dir, "events"), EVENTS_DDL)
    ours = scratch_path(spark, "v15_ours")
    write_files(events, ours, "json", "overwrite")
    back = read_json(spark, ours, EVENTS_DDL)
    assert back.exceptAll(events).count() == 0 and events.exceptAll(back).count() == 0
    plain = scratch_path(spark, "v15_plain")
    events.write.mode("overwrite").json(plain)
    plain_back = spark.read.schema(EVENTS_DDL).json(plain)
    has_micros = events.filter(
        F.substring(F.date_format("ts", "SSSSSS"), 4, 3) != "000").count() > 0
    if has_micros:
        assert plain_back.exceptAll(events).count() > 0


def test_v16_managed_name_reusable_across_runs(spark, sf_dir):
    region = read_parquet(spark, table_path(sf_dir, "region"))
    for _ in range(2):
        db = catalog.new_database(spark, "v16")
        assert catalog.save_managed(region, f"{db}.fixed_name", "overwrite").count() == 5


def test_k4_error_mode_refuses_existing_path(spark, sf_dir):
    path = scratch_path(spark, "k4")
    region = read_parquet(spark, table_path(sf_dir, "region"))
    write_files(region, path, "parquet")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_files(region, path, "parquet")
    with pytest.raises(ValueError):
        write_files(region, path, "parquet", "upsert")


def test_t1_drop_keeps_external_files_removes_managed(spark, sf_dir, folder):
    db = catalog.new_database(spark, "t1")
    region = read_parquet(spark, table_path(sf_dir, "region"))
    ext_path = os.path.join(folder, "t1_ext")
    catalog.save_external(region, f"{db}.ext", ext_path)
    catalog.save_managed(region, f"{db}.man")
    man_path = spark.sql(f"DESCRIBE EXTENDED {db}.man").filter(
        F.col("col_name") == "Location").first()["data_type"]
    catalog.drop_table(spark, f"{db}.ext")
    catalog.drop_table(spark, f"{db}.man")
    catalog.drop_table(spark, f"{db}.man")       # idempotent
    assert read_parquet(spark, ext_path).count() == 5
    assert not os.path.exists(man_path.removeprefix("file:"))


def test_case_insensitive_names_keep_query_spelling(spark, folder):
    weather = read_parquet(spark, write_weather(spark, os.path.join(folder, "case")), WEATHER_DDL)
    per_name = weather.groupBy("name").count()
    assert per_name.columns == ["name", "count"]
    assert per_name.count() == 17


def test_parquet_timestamp_ntz_is_kept(spark, sf_dir):
    orders = read_parquet(spark, table_path(sf_dir, "orders"))
    assert dict(orders.dtypes)["o_orderdate"] == "timestamp_ntz"
    first = orders.orderBy("o_orderkey").first()["o_orderdate"]
    assert isinstance(first, dt.datetime) and first.tzinfo is None


def test_release_deletes_only_scratch_outputs(spark, sf_dir):
    from tablejobs.session import release
    path = scratch_path(spark, "release_me")
    write_files(read_parquet(spark, table_path(sf_dir, "region")), path, "parquet")
    assert read_parquet(spark, path).count() == 5
    assert release(spark, path) is True
    assert not os.path.exists(path.removeprefix("file:"))
    with pytest.raises(ValueError):
        release(spark, table_path(sf_dir, "region"))


def test_csv_roundtrip_of_a_whole_table_is_exact(spark, sf_dir):
    """Doubles and microsecond timestamps survive CSV with the text options."""
    from tablejobs.schemas import LINEITEM_DDL
    from tablejobs.sources import write_csv
    lineitem = read_parquet(spark, table_path(sf_dir, "lineitem"), LINEITEM_DDL)
    path = scratch_path(spark, "lineitem_csv_rt")
    write_csv(lineitem, path, "overwrite")
    back = read_csv(spark, path, header=True, schema=LINEITEM_DDL)
    assert back.count() == lineitem.count()
    assert back.exceptAll(lineitem).isEmpty() and lineitem.exceptAll(back).isEmpty()


def test_csv_writer_would_trim_spaces_by_default(spark):
    """Spark's own CSV writer trims; write_csv keeps values as they are."""
    from tablejobs.sources import write_csv
    df = spark.createDataFrame([(1, " padded ")], "id INT, v STRING")
    plain = scratch_path(spark, "trim_plain")
    df.write.option("header", True).csv(plain)
    assert read_csv(spark, plain, header=True, schema="id INT, v STRING").first()["v"] == "padded"
    ours = scratch_path(spark, "trim_ours")
    write_csv(df, ours)
    assert read_csv(spark, ours, header=True, schema="id INT, v STRING").first()["v"] == " padded "


def test_metadata_frame_small_and_large(spark):
    from tablejobs.schemas import SCHEMA_ROWS_SCHEMA, metadata_frame
    small = metadata_frame(spark, [("a", "int", True), ("b'q", "string", False)], SCHEMA_ROWS_SCHEMA)
    assert [tuple(r) for r in small.collect()] == [("a", "int", True), ("b'q", "string", False)]
    big_rows = [(f"c{i}", "int", i % 2 == 0) for i in range(501)]
    big = metadata_frame(spark, big_rows, SCHEMA_ROWS_SCHEMA)
    assert big.count() == 501 and big.schema == SCHEMA_ROWS_SCHEMA
    assert metadata_frame(spark, [], SCHEMA_ROWS_SCHEMA).count() == 0


def test_catalog_rejects_unsafe_names_and_locations(spark):
    with pytest.raises(ValueError):
        catalog.register_files(spark, "t; DROP TABLE x", "/tmp/x")
    with pytest.raises(ValueError):
        catalog.register_files(spark, "safe_name", "/tmp/it's")
