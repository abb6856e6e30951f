"""Edge cases of the generic operators found in review."""

import pytest

from tablejobs import operators as ops
from tablejobs.functions import to_celsius
from tablejobs.schemas import SCHEMA_ROWS_SCHEMA, metadata_frame


def test_group_count_keeps_a_key_named_count(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "count INT")
    out = ops.group_count(df, "count", name="n")
    assert out.columns == ["count", "n"]
    assert [tuple(r) for r in out.collect()] == [(1, 2), (2, 1)]
    with pytest.raises(ValueError):
        ops.group_count(df, "count", name="COUNT")


def test_distinct_count_without_columns_counts_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "a INT")
    assert ops.distinct_count(df).first()["n"] == 2


def test_max_row_of_empty_input_has_no_row_and_dotted_names_work(spark):
    empty = spark.createDataFrame([], "a INT, b INT")
    assert ops.max_row(empty, "a", "b").count() == 0
    dotted = spark.createDataFrame([(1.5, 1), (2.5, 2)], "`Sepal.Length` DOUBLE, k INT")
    best = ops.max_row(dotted, "Sepal.Length", "k")
    assert best.columns == ["Sepal.Length", "k"] and tuple(best.first()) == (2.5, 2)


def test_metadata_frame_keeps_declared_nullability(spark):
    small = metadata_frame(spark, [("a", "int", True)], SCHEMA_ROWS_SCHEMA)
    assert small.schema == SCHEMA_ROWS_SCHEMA
    from tablejobs.catalog import DESCRIBE_SCHEMA
    assert metadata_frame(spark, [("a", "int")] * 700, DESCRIBE_SCHEMA).schema == DESCRIBE_SCHEMA


def test_having_count_operators(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k STRING")
    assert {r["k"] for r in ops.having_count(df, "k", "!=", 1).collect()} == {"a"}
    assert {r["k"] for r in ops.having_count(df, "k", "==", 1).collect()} == {"b"}
    with pytest.raises(ValueError, match="unknown comparison"):
        ops.having_count(df, "k", "~", 1)


def test_rename_of_an_unknown_column_fails(spark):
    df = spark.createDataFrame([(1,)], "a INT")
    assert ops.rename(df, {"a": "b"}).columns == ["b"]
    with pytest.raises(ValueError, match="nope"):
        ops.rename(df, {"nope": "x"})


def test_celsius_with_unknown_units(spark):
    df = spark.createDataFrame([(50.0, "F"), (10.0, "C"), (50.0, "f"), (10.0, None)],
                               "t DOUBLE, u STRING")
    strict = [r[0] for r in df.select(to_celsius("t", "u", "F", "C")).collect()]
    assert strict == [10.0, 10.0, 10.0, None]              # 'f' counts as F
    kelvin = spark.createDataFrame([(300.0, "K"), (50.0, None)], "t DOUBLE, u STRING")
    assert [r[0] for r in kelvin.select(to_celsius("t", "u", "F", "C")).collect()] == [None, None]


def test_group_sum_names_its_result(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k STRING, `x.y` INT")
    assert ops.group_sum(df, "k", "`x.y`", name="s").columns == ["k", "s"]
    plain = spark.createDataFrame([("a", 1)], "k STRING, x INT")
    assert ops.group_sum(plain, "k", "x").columns == ["k", "sum(x)"]


def test_cached_uses_the_cache_level(spark):
    df = ops.cached(spark.range(3))
    try:
        assert df.storageLevel.deserialized is True and df.storageLevel.useDisk is True
    finally:
        df.unpersist()


def test_collision_guards_and_case_rules(spark):
    df = spark.createDataFrame([(1,), (1,)], "counts INT")
    with pytest.raises(ValueError):
        ops.having_count(df, "counts", ">", 0)
    from pyspark.sql import functions as F
    assert ops.group_count(df, F.col("counts"), name="n", order=False).count() == 1
    session = spark.newSession()
    session.conf.set("spark.sql.caseSensitive", "true")
    cs = session.createDataFrame([(1,)], "a INT")
    with pytest.raises(ValueError):
        ops.rename(cs, {"A": "b"})
    assert ops.group_count(cs, "a", name="A", order=False).columns == ["a", "A"]


def test_max_row_takes_literal_names_and_identifiers_must_be_whole(spark):
    from tablejobs import catalog
    df = spark.createDataFrame([(1.5, 1)], "`a.b` DOUBLE, k INT")
    assert ops.max_row(df, "a.b", "k").columns == ["a.b", "k"]
    with pytest.raises(ValueError):
        catalog.check_identifier("iris\n")


def test_metadata_frame_refuses_null_in_non_nullable_fields(spark):
    with pytest.raises(ValueError):
        metadata_frame(spark, [("a", None, True)], SCHEMA_ROWS_SCHEMA)


def test_result_columns_are_unique_for_every_operator(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, 2)], "counts INT, n_combos INT")
    with pytest.raises(ValueError):
        ops.group_count(df, F.col("counts"), order=False)
    with pytest.raises(ValueError):
        ops.combos_per_key(df, "n_combos", ["counts"])
    with pytest.raises(ValueError):
        ops.rename(df, {"counts": "n_combos"})
    with pytest.raises(ValueError):
        metadata_frame(spark, [("a", "int")], SCHEMA_ROWS_SCHEMA)


def test_rename_checks_only_the_names_it_creates(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, ts INT")
    joined = df.alias("x").join(df.alias("y"), "a")          # columns a, ts, ts
    assert ops.rename(df, {"ts": "t2"}).columns == ["a", "t2"]
    with pytest.raises(ValueError):
        ops.rename(df, {"ts": "a"})
    assert joined.columns.count("ts") == 2


def test_projection_operators_refuse_duplicate_outputs(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, 50.0, "F")],
                               "ts TIMESTAMP_NTZ, y INT, value_c DOUBLE, u STRING")
    with pytest.raises(ValueError):
        ops.derive_dates(df, "ts", keep=("y",))
    with pytest.raises(ValueError):
        ops.convert_units(df, "value_c", "u", keep=("value_c",))
    with pytest.raises(ValueError):
        ops.max_row(df, "y", "y")
    assert [r[0] for r in df.select(to_celsius("value_c", "u", " f ", "C")).collect()] == [10.0]


def test_sort_by_position(spark):
    df = spark.createDataFrame([(2, None), (1, "b"), (1, "a"), (None, "c")], "k INT, s STRING")
    assert [tuple(r) for r in ops.sort_by_position(df, 1, 2).collect()] == [(None, "c"), (1, "a"), (1, "b"), (2, None)]
    assert [r["s"] for r in ops.sort_by_position(df, -2).collect()] == ["c", "b", "a", None]
    for bad in (0, 3, -3):
        with pytest.raises(ValueError, match="no column"):
            ops.sort_by_position(df, bad)
