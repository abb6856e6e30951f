"""Golden tests: the printed outputs of the teaching notebooks, reproduced on
fixtures that follow their schemas (tests/fixtures.py). The printed schemas,
listings, counts and column names compared with are fixed values."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tablejobs import catalog, iris, weather
from tablejobs import operators as ops
from tablejobs.plans import jobs_started
from tablejobs.schemas import IRIS_SCHEMA, WEATHER_DDL, WEATHER_SCHEMA, schema_tree
from tablejobs.sources import file_inventory, read_csv, read_parquet
from tests.fixtures import IRIS_EXTRA, IRIS_ROWS, WEATHER_STATIONS, write_iris, write_weather


@pytest.fixture(scope="module")
def folder():
    return tempfile.mkdtemp(prefix="tablejobs-golden-")


@pytest.fixture(scope="module")
def weather_path(spark, folder):
    return write_weather(spark, os.path.join(folder, "golden"))


@pytest.fixture(scope="module")
def weather_extra_path(spark, folder):
    return write_weather(spark, os.path.join(folder, "extra"), extras=True)


@pytest.fixture(scope="module")
def iris_path(folder):
    return write_iris(os.path.join(folder, "iris"))


@pytest.fixture(scope="module")
def counts(spark, weather_path):
    return weather.counts_by_station(weather.load(spark, weather_path))


def test_group_count_golden(counts):
    rows = [tuple(r) for r in counts.collect()]
    assert rows == list(WEATHER_STATIONS)
    assert counts.columns == ["NAME", "UNIT", "counts"]


def test_like_tx_golden(counts):
    rows = [tuple(r) for r in weather.stations_like(counts, "%TX%").collect()]
    assert rows == [("HOUSTON INTERCONTINENTAL AIRPORT, TX US", "F", 150),
                    ("HOUSTON WILLIAM P HOBBY AIRPORT, TX US", "C", 150)]


def test_like_is_case_sensitive(counts):
    assert ops.filter_like(counts, "NAME", "%tx%").count() == 0


def test_sum_by_unit_golden(counts):
    summed = weather.counts_by_unit(counts)
    assert summed.columns == ["UNIT", "sum(counts)"]
    assert {r[0]: r[1] for r in summed.collect()} == {"F": 1505, "C": 1054}


def test_weather_schema_all_three_ways(spark, weather_path):
    embedded = read_parquet(spark, weather_path)
    declared = read_parquet(spark, weather_path, WEATHER_SCHEMA)
    ddl = read_parquet(spark, weather_path, WEATHER_DDL)
    for df in (embedded, declared, ddl):
        assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
            ("NAME", "string"), ("STATION", "string"), ("LATITUDE", "float"),
            ("LONGITUDE", "float"), ("ELEVATION", "float"), ("DATE", "date"),
            ("UNIT", "string"), ("TAVG", "float")]
    assert declared.count() == 2559


def test_iris_inferred_schema(spark, iris_path):
    n_jobs, df = jobs_started(spark, lambda: read_csv(spark, iris_path, header=True,
                                                       infer_schema=True))
    assert n_jobs == 2
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("_c0", "int"), ("Sepal.Length", "double"), ("Sepal.Width", "double"),
        ("Petal.Length", "double"), ("Petal.Width", "double"), ("Species", "string")]
    assert df.select(F.col("`Sepal.Length`")).first()[0] == 5.1


def test_iris_declared_schema_binds_by_position(spark, iris_path):
    n_jobs, df = jobs_started(spark, lambda: read_csv(spark, iris_path, header=True,
                                                       schema=IRIS_SCHEMA))
    assert n_jobs == 0
    assert df.columns == ["index", "sepal_length", "sepal_width", "petal_length",
                          "petal_width", "species"]
    first = df.orderBy("index").first()
    assert tuple(first) == (1, 5.1, 3.5, 1.4, 0.2, "setosa")
    assert df.count() == 23


@pytest.mark.parametrize("sep", ["|", "\t", ";"])
def test_iris_other_separators(spark, folder, sep):
    path = write_iris(os.path.join(folder, f"sep{ord(sep)}"), sep=sep)
    df = read_csv(spark, path, header=True, schema=IRIS_SCHEMA, sep=sep)
    assert df.filter(F.col("species") == "setosa").count() == 20
    expected = sum(float(r[1]) for r in IRIS_ROWS + IRIS_EXTRA)
    assert df.agg(F.sum("sepal_length")).first()[0] == pytest.approx(expected)


def test_iris_no_header(spark, folder):
    path = write_iris(os.path.join(folder, "nohead"), header=False)
    df = read_csv(spark, path, header=False)
    assert df.columns == [f"_c{i}" for i in range(6)]
    assert df.count() == 23


def test_iris_table_and_setosa_view(spark, folder, iris_path):
    """CSV -> Parquet -> CREATE TABLE ... LOCATION -> view."""
    db = catalog.new_database(spark, "iris")
    out = iris.persist(iris.load(spark, iris_path), os.path.join(folder, "iris_parquet"))
    files = [r["name"] for r in file_inventory(spark, out).collect()]
    assert len(files) == 1 and files[0].endswith(".snappy.parquet")
    assert os.path.exists(os.path.join(out, "_SUCCESS"))

    table = f"{db}.iris"
    iris.register(spark, out, table)
    n_jobs_table, again = jobs_started(spark, lambda: spark.table(table))
    assert n_jobs_table == 0
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in again.schema.fields] == [
        ("index", "int", True), ("sepal_length", "double", True), ("sepal_width", "double", True),
        ("petal_length", "double", True), ("petal_width", "double", True),
        ("species", "string", True)]
    # the printed schema of the table, line for line
    assert schema_tree(again) == (
        "root\n"
        " |-- index: integer (nullable = true)\n"
        " |-- sepal_length: double (nullable = true)\n"
        " |-- sepal_width: double (nullable = true)\n"
        " |-- petal_length: double (nullable = true)\n"
        " |-- petal_width: double (nullable = true)\n"
        " |-- species: string (nullable = true)\n")
    view_jobs, setosas = jobs_started(spark, lambda: iris.setosas_view(spark, table))
    assert view_jobs == 0
    assert setosas.count() == 20


def test_lab_catalog_goldens(spark, folder, weather_path):
    """External table, managed table and an aggregate view; listing and DESCRIBE."""
    db = catalog.new_database(spark, "lab")
    registered = weather.register(spark, weather_path, os.path.join(folder, "weather_ext"),
                                  f"{db}.weather")
    catalog.save_managed(registered, f"{db}.weather_managed")
    station_counts = weather.station_counts_view(spark, f"{db}.weather")
    assert [(f.name, f.dataType.simpleString()) for f in station_counts.schema.fields] == [
        ("STATION", "string"), ("unit", "string"), ("TAVG", "float"), ("conteo", "bigint")]

    listed = {(r["name"], r["tableType"], r["isTemporary"])
              for r in catalog.list_tables(spark, db).collect()}
    assert {("weather", "EXTERNAL", False), ("weather_managed", "MANAGED", False),
            ("station_counts", "TEMPORARY", True)} <= listed
    shown = {(r["tableName"], r["isTemporary"])
             for r in catalog.show_tables(spark, db).collect()}
    assert {("weather", False), ("weather_managed", False), ("station_counts", True)} <= shown

    for table, kind in ((f"{db}.weather", "EXTERNAL"), (f"{db}.weather_managed", "MANAGED")):
        rows = {r["col_name"]: r["data_type"]
                for r in catalog.describe_summary(spark, table).collect()}
        assert rows["TAVG"] == "float" and rows["DATE"] == "date"
        assert rows["Type"] == kind and rows["Provider"] == "parquet"

    # persist the aggregate view as Parquet (the lab's last step)
    out = weather.save(spark.table("station_counts"), os.path.join(folder, "station_counts"))
    assert read_parquet(spark, out).agg(F.sum("conteo")).first()[0] == 2559


def test_counts_coded_vs_specified(spark, folder, weather_extra_path):
    """As coded TAVG is a key, so NULL temperatures form a group and are counted;
    as specified, COUNT(TAVG) skips them."""
    db = catalog.new_database(spark, "nulls")
    weather.register(spark, weather_extra_path, os.path.join(folder, "weather_nulls"),
                     f"{db}.weather")
    coded = weather.station_counts_view(spark, f"{db}.weather", "counts_coded")
    spec = weather.station_counts_view(spark, f"{db}.weather", "counts_spec", coded=False)
    null_group = coded.filter(F.col("TAVG").isNull()).collect()
    assert [(r["STATION"], r["conteo"]) for r in null_group] == [("USW00000000", 2)]
    assert spec.filter(F.col("STATION") == "USW00000000").first()["conteo"] == 151
    assert coded.agg(F.sum("conteo")).first()[0] == 2559 + 5
    assert spec.agg(F.sum("conteo")).first()[0] == 2559 + 3


def test_consistency_check(spark, weather_path, weather_extra_path):
    good = weather.consistency(weather.load(spark, weather_path)).first()
    assert (good["n_keys"], good["n_combos"], good["consistent"]) == (17, 17, True)
    extra = weather.load(spark, weather_extra_path)
    bad = weather.consistency(extra).first()
    assert (bad["n_keys"], bad["n_combos"], bad["consistent"]) == (19, 20, False)
    violations = [tuple(r) for r in weather.inconsistent_names(extra).collect()]
    assert violations == [("MOVING STATION, XX US", 2)]


def test_unique_names_and_rows_per_name(spark, weather_path):
    readings = weather.load(spark, weather_path)
    assert weather.unique_names(readings).count() == 17
    assert weather.unique_name_count(readings).first()["n_names"] == 17
    per_name = weather.rows_per_name(readings)
    assert per_name.columns == ["NAME", "counts"]
    assert per_name.agg(F.min("counts"), F.max("counts")).first() == (149, 151)
    # the lab's spelling: lower-case names resolve, the output keeps the query's spelling
    assert ops.group_count(readings, "name", order=False).columns == ["name", "counts"]


def test_limit_shows_twenty_rows(spark, weather_path):
    assert len(weather.load(spark, weather_path).limit(20).collect()) == 20


def test_convert_and_aggregate_units(spark, folder, weather_path):
    readings = weather.load(spark, weather_path)
    celsius = ops.convert_units(readings, "TAVG", "UNIT", keep=("NAME", "UNIT"))
    stats = {r["UNIT"]: r for r in ops.stats_by(celsius, "UNIT", "value_c").collect()}
    # every station's Celsius readings lie in 12 .. 19 whatever unit it reported in
    for row in stats.values():
        assert 12.0 - 1e-4 <= row["min_v"] <= row["max_v"] <= 19.0 + 1e-4
    raw = {r["UNIT"]: r for r in ops.stats_by(readings, "UNIT", "TAVG").collect()}
    assert raw["F"]["max_v"] > 50

    monthly = weather.monthly_aggregates(readings)
    out = weather.save(monthly, os.path.join(folder, "monthly"))
    saved = read_parquet(spark, out)
    assert saved.agg(F.sum("n_readings")).first()[0] == 2559
    assert saved.agg(F.min("min_c"), F.max("max_c")).first()[0] >= 12.0 - 1e-4


def test_describe_and_listing_layouts(spark, folder, weather_path):
    """DESCRIBE EXTENDED: column rows, a blank row, then the detail section;
    SHOW TABLES and listTables carry their documented fields."""
    db = catalog.new_database(spark, "layout")
    weather.register(spark, weather_path, os.path.join(folder, "weather_layout"),
                     f"{db}.weather")
    rows = [(r["col_name"], r["data_type"])
            for r in catalog.describe_extended(spark, f"{db}.weather").collect()]
    names = [c for c, _ in rows]
    assert names[:8] == ["NAME", "STATION", "LATITUDE", "LONGITUDE", "ELEVATION", "DATE",
                         "UNIT", "TAVG"]
    assert names[8] == "" and names[9] == "# Detailed Table Information"
    details = dict(rows[10:])
    assert details["Type"] == "EXTERNAL" and details["Provider"] == "parquet"
    assert details["Location"].endswith("weather_layout")
    assert catalog.show_tables(spark, db).columns == ["namespace", "tableName", "isTemporary"]
    assert catalog.list_tables(spark, db).columns == [
        "name", "database", "description", "tableType", "isTemporary"]
