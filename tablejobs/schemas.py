"""Declared schemas, as StructType objects and as DDL text.

Declaring a schema saves the schema job a reader would otherwise run (a
footer read for Parquet, a full pass for CSV inference) and, for CSV, binds
columns by position so the declared names replace the file's header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The column names and types of the two teaching datasets.
IRIS_SCHEMA = StructType([
    StructField("index", IntegerType()),
    StructField("sepal_length", DoubleType()),
    StructField("sepal_width", DoubleType()),
    StructField("petal_length", DoubleType()),
    StructField("petal_width", DoubleType()),
    StructField("species", StringType()),
])

WEATHER_DDL = ("NAME STRING, STATION STRING, LATITUDE FLOAT, LONGITUDE FLOAT, "
               "ELEVATION FLOAT, DATE DATE, UNIT STRING, TAVG FLOAT")

WEATHER_SCHEMA = StructType([
    StructField("NAME", StringType()),
    StructField("STATION", StringType()),
    StructField("LATITUDE", FloatType()),
    StructField("LONGITUDE", FloatType()),
    StructField("ELEVATION", FloatType()),
    StructField("DATE", DateType()),
    StructField("UNIT", StringType()),
    StructField("TAVG", FloatType()),
])

# Declared forms of the supplied tables (types as stored in their Parquet
# files). Reading with them costs no schema job when a DataFrame is defined.
LINEITEM_DDL = ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ")
ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
PART_DDL = ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE")
CUSTOMER_DDL = ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING")
SUPPLIER_DDL = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
NATION_DDL = "n_nationkey INT, n_name STRING, n_regionkey INT"
REGION_DDL = "r_regionkey INT, r_name STRING"
EVENTS_DDL = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING")

TABLE_DDL = {
    "lineitem": LINEITEM_DDL, "orders": ORDERS_DDL, "part": PART_DDL,
    "customer": CUSTOMER_DDL, "supplier": SUPPLIER_DDL, "nation": NATION_DDL,
    "region": REGION_DDL, "events": EVENTS_DDL,
}

CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType()),
    StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()),
    StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType()),
])

SCHEMA_ROWS_SCHEMA = StructType([
    StructField("col_name", StringType(), False),
    StructField("data_type", StringType(), False),
    StructField("nullable", BooleanType(), False),
])


def metadata_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A driver-side listing (schema fields, catalog entries) as a DataFrame with
    exactly the declared names, types and nullability."""
    for row in rows:
        if len(row) != len(schema.fields):
            raise ValueError(f"row {row!r} does not have {len(schema.fields)} fields")
        for value, field in zip(row, schema.fields):
            if value is None and not field.nullable:
                raise ValueError(f"NULL in non-nullable field {field.name!r}")
    return spark.createDataFrame(rows, schema)


def schema_tree(df: DataFrame) -> str:
    """The text ``df.printSchema()`` prints, as a string."""
    return df.schema.treeString()


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """printSchema as data: one row per top-level column (driver-side metadata)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return metadata_frame(spark, rows, SCHEMA_ROWS_SCHEMA)
