"""The weather-station jobs of the notebooks, with their column names.

Station readings: NAME, STATION, LATITUDE, LONGITUDE, ELEVATION, DATE, UNIT
(F or C), TAVG. Every function is a composition of the generic operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs import catalog
from tablejobs import operators as ops
from tablejobs.functions import to_celsius
from tablejobs.schemas import WEATHER_DDL
from tablejobs.sources import read_parquet, write_files

POSITION = ["STATION", "LATITUDE", "LONGITUDE", "ELEVATION"]


def load(spark: SparkSession, path: str, declared: bool = True) -> DataFrame:
    """Read the station Parquet files, with the DDL schema (no job) or the
    embedded one (a footer job)."""
    return read_parquet(spark, path, WEATHER_DDL if declared else None)


def register(spark: SparkSession, source_path: str, table_path: str,
             table: str = "weather") -> DataFrame:
    """Drop, copy the source to ``table_path`` and register it as an external
    table; return the table as a DataFrame."""
    catalog.drop_table(spark, table)
    return catalog.save_external(load(spark, source_path), table, table_path)


def station_counts_view(spark: SparkSession, table: str = "weather",
                        view: str = "station_counts", coded: bool = True) -> DataFrame:
    """Temp view of readings per station and unit.

    ``coded=True`` is the SQL as written in the lab: TAVG is also a key, so a
    NULL temperature forms its own group and is counted. ``coded=False`` is
    the lab's stated intent: recorded (non-NULL) temperatures per station and
    unit."""
    readings = spark.table(catalog.check_identifier(table))
    if coded:
        counted = ops.group_count(readings, "STATION", "UNIT", "TAVG", name="n")
    else:
        counted = ops.count_values(readings, "STATION", "UNIT", value="TAVG", name="n") \
            .orderBy("STATION", "UNIT")
    # The view's output names, which later steps read back.
    return catalog.view_from_df(ops.rename(counted, {"UNIT": "unit", "n": "conteo"}), view)


def counts_by_station(df: DataFrame) -> DataFrame:
    """NAME, UNIT, counts ordered by NAME."""
    return ops.group_count(df, "NAME", "UNIT", name="counts")


def stations_like(counts: DataFrame, pattern: str = "%TX%") -> DataFrame:
    return ops.filter_like(counts, "NAME", pattern)


def counts_by_unit(counts: DataFrame) -> DataFrame:
    """UNIT, sum(counts): the re-aggregation of the station counts."""
    return ops.group_sum(counts, "UNIT", "counts")


def unique_names(df: DataFrame) -> DataFrame:
    return ops.distinct_rows(df, "NAME")


def unique_name_count(df: DataFrame) -> DataFrame:
    return ops.distinct_count(df, "NAME", name="n_names")


def rows_per_name(df: DataFrame) -> DataFrame:
    return ops.group_count(df, "NAME", order=False)


def consistency(df: DataFrame) -> DataFrame:
    """One row: n_keys (distinct names), n_combos (distinct name + position),
    consistent (whether each name has exactly one position)."""
    return ops.fd_holds(df, "NAME", POSITION)


def inconsistent_names(df: DataFrame) -> DataFrame:
    return ops.fd_violations(df, "NAME", POSITION)


def with_celsius(df: DataFrame) -> DataFrame:
    """Add TAVG_C (every reading in Celsius; units read case-blind, NULL when
    the unit is neither F nor C) and the calendar YEAR and MONTH."""
    return df.select("*", to_celsius("TAVG", "UNIT", "F", "C").alias("TAVG_C"),
                     F.year("DATE").alias("YEAR"), F.month("DATE").alias("MONTH"))


def monthly_aggregates(df: DataFrame) -> DataFrame:
    """Average, minimum and maximum Celsius temperature per station and month."""
    return (with_celsius(df).groupBy("NAME", "YEAR", "MONTH")
            .agg(F.round(F.avg("TAVG_C"), 6).alias("avg_c"),
                 F.min("TAVG_C").alias("min_c"), F.max("TAVG_C").alias("max_c"),
                 F.count("TAVG_C").alias("n_readings")))


def save(df: DataFrame, path: str) -> str:
    return write_files(df, path, "parquet", "overwrite")
