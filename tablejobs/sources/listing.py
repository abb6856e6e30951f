"""Listing of the data files a write produced (path, name, size).

Uses the ``binaryFile`` source with only ``path`` and ``length`` selected, so
file contents are pruned and never read; the listing itself is distributed
for large directories. Hidden and marker files (``_SUCCESS``, ``.crc``) are
skipped by the file index like any other Spark read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "length")
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
    )
