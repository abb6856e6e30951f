"""The part files of a write: one row per file, and the check of a write against
the files it left (one per write task, task 0's present, every row found again)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablejobs.session import unique_name
from tablejobs.sources.listing import file_inventory
from tablejobs.sources.readers import read_parquet
from tablejobs.sources.writers import write_files


def write_with_inventory(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet (natural parallelism, one file per task) and
    check the part-file listing against the write.

    The write counts its own rows as it goes (an observed metric), so ``df``
    is computed once, and the count is exactly what was written even for an
    input that would differ on a second run. Returns one row: ``files_match``,
    ``sizes_match`` and ``n_rows`` (rows read back from the listed files)."""
    observed = Observation(unique_name("written"))
    write_files(df.observe(observed, F.count(F.lit(1)).alias("rows")), path, "parquet",
                "overwrite", maxRecordsPerFile=0)
    return check_inventory(df.sparkSession, path, observed.get["rows"], df.schema)


def part_files(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One row per Parquet part file at ``path``: ``name``, the number of the write task
    (``task``, from the name; NULL for other names), the listed ``size``, the size its rows
    were read with (``read_size``, NULL for a file without rows) and ``n_rows``. All of it
    is one union of listing and rows, aggregated by file; rows are counted in the scan's
    tasks first."""
    digits = F.regexp_extract("name", r"^part-(\d+)", 1)
    task = F.when(digits != "", digits.cast("int"))
    files = file_inventory(spark, path, "*.parquet").select(
        "name", task.alias("task"), F.lit(0).alias("r"),
        F.col("size").alias("listed"), F.lit(None).cast("bigint").alias("seen"))
    try:
        rows = read_parquet(spark, path, schema).select(
            F.col("_metadata.file_name").alias("name"), F.lit(None).cast("int").alias("task"),
            F.lit(1).alias("r"), F.lit(None).cast("bigint").alias("listed"),
            F.col("_metadata.file_size").alias("seen"))
        parts = files.unionByName(rows)
    except AnalysisException as error:      # no file left to take a schema from
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        parts = files
    return parts.groupBy("name").agg(
        F.max("task").alias("task"), F.max("listed").alias("size"), F.max("seen").alias("read_size"),
        F.sum("r").cast("bigint").alias("n_rows"))


def write_numbered(df: DataFrame, path: str, task: Column, tasks: int) -> DataFrame:
    """Write ``df`` as Parquet so that each row lands in the part file of the task its
    ``task`` (an integer from 0 to ``tasks`` - 1) names, and return the files'
    rows (``part_files``). One shuffle; choose ``tasks`` for files of about a gigabyte."""
    write_files(df.repartitionById(tasks, task.cast("int")), path, "parquet", "overwrite", maxRecordsPerFile=0)
    return part_files(df.sparkSession, path, df.schema)


def check_inventory(spark: SparkSession, path: str, expected_rows: int | None = None,
                    schema: StructType | None = None) -> DataFrame:
    """Check Parquet part files at ``path`` (see ``part_files``): every listed file belongs
    to a distinct write task (other names count as a mismatch), task 0's file is there
    (Spark keeps it even when empty, so the schema survives), and, when ``expected_rows``
    is given, the listed files hold exactly that many rows, which also catches a missing
    file. Per file, the listed size is held against the one its rows were read with
    (``sizes_match``)."""
    per_file = part_files(spark, path, schema)
    totals = per_file.agg(
        F.count("size").alias("n_files"), F.count_distinct("task").alias("n_tasks"),
        F.min("task").alias("first_task"),
        F.bool_and(F.coalesce(F.col("size") == F.col("read_size"), F.col("n_rows") == 0)).alias("sizes"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"))
    match = (F.col("n_files") == F.col("n_tasks")) & (F.col("first_task") == 0)
    if expected_rows is not None:
        match = match & (F.col("n_rows") == F.lit(expected_rows))
    return totals.select(F.coalesce(match, F.lit(False)).alias("files_match"),
                         F.coalesce("sizes", F.lit(False)).alias("sizes_match"), "n_rows")
