"""What the files of a folder really hold: schema audit by Parquet footers.

Declaring a schema saves the footer job, and then one odd file among many goes
unnoticed: a missing column reads as NULL, another type fails in the middle of a
job. The audit reads every footer, on the executors (a footer is some kilobytes;
no data page is touched), and counts files and rows per column and stored type.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablejobs.session import name_fold
from tablejobs.sources.listing import file_inventory

#: What Spark keeps of its own schema in the footers it writes: a fixed value.
_SPARK_SCHEMA_KEY = b"org.apache.spark.sql.parquet.row.metadata"
_FOOTER = "path string, n_rows long, col_name string, data_type string"
#: ``data_type`` of a file without a readable footer (its ``col_name`` is NULL).
UNREADABLE = "not parquet"


def footers(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """One row (path, n_rows, col_name, data_type) per file and column below ``path``.
    Types are Spark's: as the footer states them where Spark wrote the file, else
    derived from the stored ones. A file with no columns or an unreadable footer has one
    row with a NULL name. Files are opened through pyarrow's file systems."""
    files = file_inventory(spark, path, glob).select("path")
    key = _SPARK_SCHEMA_KEY

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type

        def opened(uri: str):
            if uri.startswith("file:"):
                return pafs.LocalFileSystem().open_input_file("/" + uri[5:].lstrip("/"))
            fs, inner = pafs.FileSystem.from_uri(uri)
            return fs.open_input_file(inner)

        def columns(meta) -> list[tuple[str | None, str | None]]:
            stated = (meta.metadata or {}).get(key)
            if stated:
                return [(f.name, f.dataType.simpleString())
                        for f in StructType.fromJson(json.loads(stated)).fields]
            found = []
            for field in meta.schema.to_arrow_schema():
                try:
                    kind = from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString()
                except Exception:                       # a type Spark has no name for
                    kind = str(field.type)
                found.append((field.name, kind))
            return found

        for batch in batches:
            rows = []
            for uri in batch.column(0).to_pylist():
                try:
                    with opened(uri) as source:
                        meta = pq.read_metadata(source)
                        rows += [(uri, meta.num_rows, *c) for c in columns(meta) or [(None, None)]]
                except pa.ArrowInvalid:                 # not a Parquet file; a lost file still fails
                    rows.append((uri, None, None, UNREADABLE))
            cells = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cells, (pa.string(), pa.int64(), pa.string(), pa.string()))],
                ["path", "n_rows", "col_name", "data_type"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(parts).mapInArrow(read, _FOOTER)


def schema_audit(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """One row per column and stored type: how many files hold it so and with how many
    rows, and whether those are all files (``every_file``). Unreadable files are a row with
    a NULL name. Names are as stored; an empty folder has no rows."""
    per_column = footers(spark, path, glob).groupBy("col_name", "data_type").agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    total = F.lit(file_inventory(spark, path, glob).count())
    return per_column.withColumn("every_file", F.col("n_files") == total)


def schema_offences(spark: SparkSession, path: str, schema: StructType | str,
                    glob: str = "*.parquet") -> DataFrame:
    """What stands against reading ``path`` with ``schema``: one row (col_name, declared,
    data_type, n_files) per declared column and stored type that differs, with a NULL
    ``data_type`` for files that lack the column, and per unreadable file kind. No rows: every
    file holds every declared column with its type. Names compare as in this session."""
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    fold = name_fold(spark)
    names = {fold(f.name): f.dataType.simpleString() for f in declared.fields}
    spelled = {fold(f.name): f.name for f in declared.fields}
    audit = [r.asDict() for r in schema_audit(spark, path, glob).collect()]   # columns x types, no files
    total = file_inventory(spark, path, glob).count() if audit else 0
    rows, seen = [], dict.fromkeys(names, 0)
    for r in audit:
        if r["col_name"] is None:
            if r["data_type"] == UNREADABLE:
                rows.append((None, None, UNREADABLE, r["n_files"]))
            continue
        key = fold(r["col_name"])
        if key in names:
            seen[key] += r["n_files"]
            if r["data_type"] != names[key]:
                rows.append((spelled[key], names[key], r["data_type"], r["n_files"]))
    rows += [(spelled[k], names[k], None, total - n) for k, n in seen.items() if n < total]
    return spark.createDataFrame(rows, "col_name string, declared string, data_type string, n_files long")
