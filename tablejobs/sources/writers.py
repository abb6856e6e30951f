"""File sinks with explicit save modes.

``overwrite`` replaces what is at the path, ``append`` adds part files,
``ignore`` writes nothing when data exists, ``error``/``errorifexists`` (the
default) fails when data exists. Executors write part files; the driver only
commits, so the write scales with the cluster and survives lost executors
(failed tasks are retried, uncommitted attempts are discarded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablejobs.sources.readers import TEXT_TIMESTAMP_OPTIONS

SAVE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def write_files(df: DataFrame, path: str, fmt: str | None = "parquet",
                mode: str = "errorifexists", **options) -> str:
    """Write ``df`` to ``path``; ``fmt=None`` uses the session default format."""
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; expected one of {SAVE_MODES}")
    writer = df.write.mode(mode)
    if fmt is not None:
        writer = writer.format(fmt)
    # Text formats (csv, json, xml, ... under any name) use these; binary
    # formats ignore them, so they go with every write.
    writer = writer.options(**TEXT_TIMESTAMP_OPTIONS)
    writer.options(**options).save(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", *,
              header: bool = True, sep: str = ",", **options) -> str:
    """CSV sink that keeps values as they are: Spark's writer would otherwise
    trim leading and trailing spaces. NULL is written as an empty field; pass
    ``**NULL_MARKER_OPTIONS`` here and to ``read_csv`` to keep NULL and the
    empty string apart."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return write_files(df, path, "csv", mode, header=header, sep=sep, **{**keep, **options})
