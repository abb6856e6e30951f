"""CSV that gives back exactly what was written, one line per row.

Spark's CSV alone loses values: NULL and the empty string look alike, a literal
``\\N`` reads as NULL under a NULL marker, and line breaks inside values need
``multiLine``, with which a file can't be split any more. Here strings are escaped
before they are written and unescaped after they are read, by built-in functions:
a backslash becomes ``\\b``, a line feed ``\\n``, a carriage return ``\\r``, so that
the NULL marker ``\\N`` can't be the text of a value and every row stays one line,
whatever the size of the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DataType, DateType, NumericType, StringType, StructField, StructType,
    TimestampNTZType, TimestampType,
)

from tablejobs.sources.readers import NULL_MARKER_OPTIONS, TEXT_TIMESTAMP_OPTIONS, read_csv
from tablejobs.sources.writers import write_csv

_PAIRS = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))
_AS_THEY_ARE = (NumericType, BooleanType, DateType)
#: Quotes inside values are doubled; spaces stay.
_OPTIONS = {**NULL_MARKER_OPTIONS, "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def escaped(column: Column) -> Column:
    for plain, code in _PAIRS:
        column = F.replace(column, F.lit(plain), F.lit(code))
    return column


def unescaped(column: Column) -> Column:
    for plain, code in reversed(_PAIRS):
        column = F.replace(column, F.lit(code), F.lit(plain))
    return column


def _text(field: StructField) -> Column:
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, StringType):
        return escaped(column)
    if isinstance(kind, BinaryType):
        return F.base64(column)
    if isinstance(kind, TimestampNTZType):
        return F.date_format(column, TEXT_TIMESTAMP_OPTIONS["timestampNTZFormat"])
    if isinstance(kind, TimestampType):
        return F.date_format(column, TEXT_TIMESTAMP_OPTIONS["timestampFormat"])
    if isinstance(kind, _AS_THEY_ARE):
        return column.cast("string")
    raise ValueError(f"{field.name}: {kind.simpleString()} has no exact text form")


def _value(name: str, kind: DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(kind, StringType):
        return unescaped(column)
    if isinstance(kind, BinaryType):
        return F.unbase64(column)
    return column.cast(kind)


def write_csv_exact(df: DataFrame, path: str, mode: str = "errorifexists", *, header: bool = True,
                    sep: str = ",") -> str:
    """Write numbers, booleans, strings, dates, timestamps and binary values as text that
    ``read_csv_exact`` gives back unchanged. Nested types are refused."""
    texts = [_text(f).alias(f.name) for f in df.schema.fields]
    return write_csv(df.select(*texts), path, mode, header=header, sep=sep, **_OPTIONS)


def read_csv_exact(spark: SparkSession, path: str, schema: StructType | str, *, header: bool = True,
                   sep: str = ",") -> DataFrame:
    """Read what ``write_csv_exact`` wrote, with its schema (bound by position)."""
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    texts = StructType([StructField(f.name, StringType()) for f in declared.fields])
    raw = read_csv(spark, path, header=header, schema=texts, sep=sep, **_OPTIONS)
    return raw.select(*[_value(f.name, f.dataType).alias(f.name) for f in declared.fields])
