"""Every registered job against its DuckDB oracle on the supplied sf0.01 tables."""

import pytest

import __spark_entry__ as entry_mod
from tablejobs.oracle import ORACLE_SQL
from tests.compare import compare, duck_connection
from tablejobs.jobs import JOBS
from tablejobs.jobs import ORDERED_JOBS as ORDERED

QUERIES = {k: entry_mod.queries()[k] for k in JOBS}
ORACLES = {k: entry_mod.oracle_sql()[k] for k in JOBS}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connection(sf_dir)




@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, con, key):
    df = QUERIES[key](spark, sf_dir)
    assert compare(df, con, ORACLES[key], ordered=key in ORDERED) == []


def test_every_job_has_an_oracle():
    assert set(JOBS) == set(ORACLE_SQL)


def test_raw_preview_rows(spark, sf_dir):
    rows = QUERIES["raw_preview"](spark, sf_dir).collect()
    assert len(rows) == 20
    assert rows[0]["value"].startswith("c_custkey,c_name")


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["l_returnflag", "l_linestatus", "counts"]
    assert len(rows) > 0
    keys = [(r[0], r[1]) for r in rows]
    assert keys == sorted(keys)


def test_ordered_compare_reports_order_and_value_differences(spark, con):
    sql = "SELECT * FROM (VALUES (1, 'a'), (2, 'b')) t(k, v) ORDER BY k"
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    swapped = spark.createDataFrame([(2, "b"), (1, "a")], "k INT, v STRING")
    doubled = spark.createDataFrame([(1, "a"), (1, "a")], "k INT, v STRING")
    assert compare(good, con, sql, ordered=True) == []
    assert compare(swapped, con, sql, ordered=True) == ["same rows, different order"]
    assert compare(swapped, con, sql) == []
    assert compare(doubled, con, sql)[0].startswith("values differ")
