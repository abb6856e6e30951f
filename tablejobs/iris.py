"""The iris CSV jobs of the notebooks: read with inferred or declared schema,
persist as Parquet, register the files as a table, define the setosa view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablejobs import catalog
from tablejobs import operators as ops
from tablejobs.schemas import IRIS_SCHEMA
from tablejobs.sources import read_csv, write_files


def load(spark: SparkSession, path: str, declared: bool = True, sep: str = ",") -> DataFrame:
    """Declared: positional names index, sepal_length, ... (no job). Inferred:
    the file's own header (first name empty, so ``_c0``), two jobs."""
    if declared:
        return read_csv(spark, path, header=True, schema=IRIS_SCHEMA, sep=sep)
    return read_csv(spark, path, header=True, infer_schema=True, sep=sep)


def persist(df: DataFrame, path: str) -> str:
    """Write as Parquet (overwrite), one file per task."""
    return write_files(df, path, "parquet", "overwrite")


def register(spark: SparkSession, parquet_path: str, table: str = "iris") -> DataFrame:
    """DROP TABLE IF EXISTS, then CREATE TABLE ... USING PARQUET LOCATION."""
    catalog.drop_table(spark, table)
    return catalog.register_files(spark, table, parquet_path)


def setosas_view(spark: SparkSession, table: str = "iris", view: str = "setosas") -> DataFrame:
    source = spark.table(catalog.check_identifier(table))
    return catalog.view_from_df(ops.filter_eq(source, "species", "setosa"), view)
