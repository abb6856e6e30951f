"""Tables, views and the session catalog.

External tables keep their data at a path we give (dropping the table leaves
the files); managed tables let the catalog own both. Temporary views are
session-scoped names for a plan; defining one runs no job.

Each job works in a database of its own, located under the shared scratch
root, so a rerun never collides with files a previous run left behind in a
warehouse folder (a second run of a fixed managed name fails otherwise).
Listings are returned as DataFrames of catalog metadata: small by nature.
"""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tablejobs.schemas import metadata_frame
from tablejobs.session import name_fold, scratch_path, unique_name
from tablejobs.sources.readers import TEXT_TIMESTAMP_OPTIONS

_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")     # fullmatch

DESCRIBE_SCHEMA = StructType([
    StructField("col_name", StringType()),
    StructField("data_type", StringType()),
])

LIST_TABLES_SCHEMA = StructType([
    StructField("name", StringType()),
    StructField("database", StringType()),
    StructField("description", StringType()),
    StructField("tableType", StringType()),
    StructField("isTemporary", BooleanType()),
])


def _check(name: str) -> str:
    if not _IDENT.fullmatch(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def check_identifier(name: str) -> str:
    """``name`` if it is a plain (optionally database-qualified) identifier."""
    return _check(name)


def _literal(text: str, what: str) -> str:
    """Text for a quoted literal in DDL or SHOW (no parameter markers there)."""
    if "'" in text or "\\" in text:
        raise ValueError(f"unsupported character in {what} {text!r}")
    return text


def new_database(spark: SparkSession, label: str = "tj") -> str:
    """Create a fresh database whose files live below the shared scratch root."""
    db = unique_name(f"db_{label}")
    location = scratch_path(spark, db)
    spark.sql(f"CREATE DATABASE {_check(db)} LOCATION '{_literal(location, 'location')}'")
    return db


def drop_table(spark: SparkSession, table: str) -> None:
    """Idempotent drop; an external table's files stay, a managed table's go."""
    spark.sql(f"DROP TABLE IF EXISTS {_check(table)}")


def save_external(df: DataFrame, table: str, path: str, mode: str = "overwrite",
                  fmt: str = "parquet") -> DataFrame:
    """Write ``df`` to ``path`` and register it as an external table."""
    (df.write.format(fmt).mode(mode).options(**TEXT_TIMESTAMP_OPTIONS).option("path", path)
     .saveAsTable(_check(table)))
    return df.sparkSession.table(table)


def save_managed(df: DataFrame, table: str, mode: str = "overwrite",
                 fmt: str = "parquet") -> DataFrame:
    """Write ``df`` as a managed table (the catalog owns the files)."""
    df.write.format(fmt).mode(mode).options(**TEXT_TIMESTAMP_OPTIONS).saveAsTable(_check(table))
    return df.sparkSession.table(table)


def register_files(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Register files already at ``path`` as a table; no data is copied."""
    if not re.fullmatch(r"[A-Za-z0-9_]+", fmt):
        raise ValueError(f"bad format {fmt!r}")
    spark.sql(f"CREATE TABLE {_check(table)} USING {fmt} LOCATION '{_literal(path, 'location')}'")
    return spark.table(table)


def append_to_table(df: DataFrame, table: str) -> DataFrame:
    """Append through the catalog so later reads of the table see the rows.

    Appending to a table's path directly leaves cached file listings stale
    until the table is refreshed; going through the table avoids that.
    ``INSERT INTO ... BY NAME`` matches columns by name (``insertInto`` would
    match by position). A column the table has but ``df`` lacks must carry a
    DEFAULT (which Spark fills in); otherwise, and for extra columns, the
    append fails instead of writing NULLs or dropping data."""
    spark = df.sparkSession
    fold = name_fold(spark)
    fields = {fold(f.name): f for f in spark.table(_check(table)).schema.fields}
    given = {fold(c) for c in df.columns}
    missing = sorted(c for c in set(fields) - given
                     if "CURRENT_DEFAULT" not in fields[c].metadata)
    extra = sorted(given - set(fields))
    if missing or extra:
        raise ValueError(f"columns differ from {table}: missing={missing} extra={extra}")
    source = unique_name("append_src")
    df.createOrReplaceTempView(source)
    try:
        spark.sql(f"INSERT INTO {_check(table)} BY NAME SELECT * FROM {source}")
    finally:
        spark.catalog.dropTempView(source)
    df.sparkSession.catalog.refreshTable(table)
    return df.sparkSession.table(table)


def refresh(spark: SparkSession, table: str) -> DataFrame:
    """Re-list a table's files after something wrote to its path directly."""
    spark.catalog.refreshTable(_check(table))
    return spark.table(table)


def view_from_df(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame's plan as a temporary view (no job)."""
    df.createOrReplaceTempView(_check(name))
    return df.sparkSession.table(name)


def view_from_sql(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    """``CREATE OR REPLACE TEMP VIEW name AS (select)``; lazy, no job."""
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {_check(name)} AS ({select_sql})")
    return spark.table(name)


def run_sql(spark: SparkSession, text: str, **args) -> DataFrame:
    """Parameterised SQL: values bind as ``:name`` markers, identifiers through
    ``IDENTIFIER(:name)``; nothing is pasted into the SQL text."""
    return spark.sql(text, args=args or None)


def list_tables(spark: SparkSession, database: str | None = None,
                pattern: str | None = None) -> DataFrame:
    """``catalog.listTables`` as rows (name, database, description, tableType,
    isTemporary). Newer catalogs report a namespace list; it is flattened to
    the single ``database`` field."""
    rows = []
    for t in spark.catalog.listTables(database, pattern):
        namespace = getattr(t, "namespace", None)
        db = t.database if getattr(t, "database", None) else (
            ".".join(namespace) if namespace else None)
        rows.append((t.name, db, t.description, t.tableType, bool(t.isTemporary)))
    return metadata_frame(spark, rows, LIST_TABLES_SCHEMA)


def show_tables(spark: SparkSession, database: str, pattern: str | None = None) -> DataFrame:
    """``SHOW TABLES IN db [LIKE pattern]``: namespace, tableName, isTemporary."""
    like = f" LIKE '{_literal(pattern, 'pattern')}'" if pattern else ""
    return spark.sql(f"SHOW TABLES IN {_check(database)}{like}")


def describe_extended(spark: SparkSession, table: str) -> DataFrame:
    """``DESCRIBE EXTENDED``: column rows, a blank row, then table details."""
    return spark.sql(f"DESCRIBE EXTENDED {_check(table)}")


def describe_summary(spark: SparkSession, table: str) -> DataFrame:
    """One row per column (name, type) followed by the table's ``Type``
    (EXTERNAL / MANAGED) and ``Provider``: the parts of ``DESCRIBE EXTENDED``
    that hold across catalogs. Columns come from the table schema, details
    from the machine-readable ``DESCRIBE ... AS JSON``; catalog metadata."""
    rows = [(f.name, f.dataType.simpleString())
            for f in spark.table(_check(table)).schema.fields]
    try:
        details = json.loads(spark.sql(f"DESCRIBE EXTENDED {table} AS JSON").first()[0])
        kind, provider = details.get("type"), details.get("provider")
    except AnalysisException:
        # catalogs without the JSON form: read the detail section of the text form
        kind, provider = _detail_rows(spark, table, ("Type", "Provider"))
    rows += [("Type", kind), ("Provider", provider)]
    return metadata_frame(spark, rows, DESCRIBE_SCHEMA)


def _detail_rows(spark: SparkSession, table: str, keys: tuple[str, ...]) -> list[str | None]:
    """Values of ``keys`` in the section after '# Detailed Table Information'."""
    found: dict[str, str] = {}
    in_details = False
    for row in describe_extended(spark, table).collect():
        name = row["col_name"]
        if name == "# Detailed Table Information":
            in_details = True
        elif in_details and name.startswith("#"):
            break
        elif in_details and name in keys and name not in found:
            found[name] = row["data_type"]
    return [found.get(k) for k in keys]
