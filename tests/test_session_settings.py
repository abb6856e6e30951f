"""Jobs agree with their oracles under session settings a driver may use."""

import pytest

from tests.compare import compare, duck_connection
from tablejobs.jobs import JOBS, ORDERED_JOBS
from tablejobs.oracle import ORACLE_SQL
from tablejobs.session import release_all

CASES = [
    ({"spark.sql.files.openCostInBytes": "1024"}, ["file_inventory", "repartition_coalesce"]),
    ({"spark.sql.files.maxRecordsPerFile": "5"}, ["raw_preview", "file_inventory"]),
    ({"spark.sql.sources.default": "json"}, ["default_format"]),
    ({"spark.sql.sources.default": "csv"}, ["default_format"]),
    ({"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"},
     ["group_count", "fd_check", "view_counts_coded", "distinct_count"]),
    # timestamp_ntz values must not move with the session time zone
    ({"spark.sql.ansi.enabled": "false", "spark.sql.session.timeZone": "America/Lima"},
     ["derive_cols", "json_roundtrip", "csv_infer", "convert_units", "select_cols"]),
]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connection(sf_dir)


@pytest.mark.parametrize("conf, keys", CASES,
                         ids=[",".join(f"{k}={v}" for k, v in c.items()) for c, _ in CASES])
def test_jobs_hold_under_session_settings(spark, sf_dir, con, conf, keys):
    session = spark.newSession()
    try:
        for key, value in conf.items():
            session.conf.set(key, value)
        for key in keys:
            result = JOBS[key](session, sf_dir)
            assert compare(result, con, ORACLE_SQL[key], ordered=key in ORDERED_JOBS) == [], \
                (conf, key)
    finally:
        release_all(session)
