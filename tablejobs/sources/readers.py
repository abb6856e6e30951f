"""File readers: CSV, Parquet, JSON, generic format, raw text preview.

Every reader is lazy except where Spark itself must look at the data to
learn a schema: CSV inference (a full pass plus the header), Parquet without a
declared schema (a footer read). Passing a schema makes the read free until an
action runs, which is the scale path: at 100 TB an inference pass is a second
full scan of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablejobs.session import hadoop_fs, name_fold
from tablejobs.sources.listing import file_inventory

# Text writers keep microseconds only with explicit patterns (the
# defaults cut both timestamp types to milliseconds). Applied on write only:
# readers keep Spark's lenient ISO parser, which reads these values exactly
# and also accepts other spellings (a strict read pattern would turn them
# into NULL).
TEXT_TIMESTAMP_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

# CSV writes NULL and the empty string alike unless NULL gets a marker of its
# own; give these options to both the writer and the reader of a round trip.
NULL_MARKER_OPTIONS = {"nullValue": "\\N"}


def read_csv(spark: SparkSession, path: str, *, header: bool = True,
             infer_schema: bool = False, schema: StructType | str | None = None,
             sep: str = ",", **options) -> DataFrame:
    """CSV scan. With ``schema`` columns bind by position; the header (if any)
    is still skipped. Without schema and inference, every column is a string;
    without a header, columns are ``_c0.._cN``. Values holding line breaks
    need ``multiLine=True``, which makes each file one task: leave it off for
    large inputs that have none."""
    reader = spark.read.format("csv").option("header", header).option("sep", sep)
    reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.load(path)


def read_parquet(spark: SparkSession, path: str,
                 schema: StructType | str | None = None) -> DataFrame:
    """Parquet scan; the embedded footer schema unless one is declared.
    A declared column missing from the files comes back as NULL."""
    reader = spark.read.format("parquet")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_json(spark: SparkSession, path: str,
              schema: StructType | str | None = None, **options) -> DataFrame:
    """JSON-lines scan. Give a schema: without it Spark infers (a full pass),
    sorts the columns by name and returns timestamps as strings."""
    reader = spark.read.format("json").options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """``df`` (inferred from JSON, say) with the declared columns, in their order and
    with their types, found by name; a missing one is NULL, others are left out.
    A value that doesn't read as its declared type fails (ANSI) or becomes NULL."""
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    fold = name_fold(df.sparkSession)
    have = {fold(c): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[fold(f.name)]}`") if fold(f.name) in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in declared.fields])


def read_files(spark: SparkSession, path: str, fmt: str | None = None,
               schema: StructType | str | None = None, **options) -> DataFrame:
    """Generic ``format(f).load(p)``; with no format the session default
    (``spark.sql.sources.default``, Parquet unless changed) is used."""
    reader = spark.read
    if fmt is not None:
        reader = reader.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def first_data_file(spark: SparkSession, path: str) -> str:
    """The first data file by path under ``path`` (a file, a folder or a glob;
    partition folders included): the minimum over a ``binaryFile`` listing whose
    contents are pruned, in one job. Zero-length files are left out; a file that
    holds only a header (what a write task without rows leaves) counts as one."""
    first = file_inventory(spark, path).agg(F.min("path")).first()[0]
    if first is not None:
        return first
    fs, hpath = hadoop_fs(spark, path)      # file scans skip zero-length files
    if fs.exists(hpath) and fs.getFileStatus(hpath).isFile():
        return path
    raise FileNotFoundError(f"no data file in {path}")


def raw_preview(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """First ``n`` lines of one text file, unparsed (what ``head`` on the
    file shows); for a folder or glob, of its first file by path (see
    ``first_data_file``). The limit is the feature here; Spark stops reading
    after it."""
    return spark.read.text(first_data_file(spark, path)).limit(n)


def require_columns(spark: SparkSession, path: str, schema: StructType | str,
                    fmt: str = "parquet", every_file: bool = False) -> DataFrame:
    """Read ``path`` with a declared schema after checking it against the
    schema stored in the files (one footer job).

    Parquet silently returns NULL for a declared name it does not find and
    fails only at an action on a wrong type; this check fails early with the
    list of offending columns instead. Spark takes the stored schema from one
    footer; ``every_file`` (Parquet only) holds the declaration against all of
    them (see ``sources.audit``)."""
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if every_file:
        from tablejobs.sources.audit import schema_offences
        found = [tuple(r) for r in schema_offences(spark, path, declared).collect()]
        if found:
            raise ValueError(f"schema does not match all files of {path}: {found}")
        return spark.read.format(fmt).schema(declared).load(path)
    stored = spark.read.format(fmt).load(path).schema
    fold = name_fold(spark)
    fields = {fold(f.name): f for f in stored.fields}
    missing, wrong = [], []
    for f in declared.fields:
        found = fields.get(fold(f.name))
        if found is None:
            missing.append(f.name)
        elif found.dataType.simpleString() != f.dataType.simpleString():
            wrong.append(f"{f.name}: declared {f.dataType.simpleString()}, "
                         f"stored {found.dataType.simpleString()}")
    if missing or wrong:
        raise ValueError(f"schema does not match {path}: missing={missing} wrong_type={wrong}")
    return spark.read.format(fmt).schema(declared).load(path)
