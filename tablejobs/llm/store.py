"""Intermediate tables in the folder the cluster shares (spark.checkpoint.dir)."""

from __future__ import annotations

import os
from contextlib import contextmanager

import tablejobs
from pyspark.sql import DataFrame, SparkSession

from tablejobs.session import release, scratch_path

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(tablejobs.__file__)))


def shipped(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, also when
    they start in another folder. (A cluster gets the package by --py-files.)"""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


_WORK: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession):
    """Tables saved inside go when this ends; those saved with ``keep`` go with the one around it, if any."""
    paths: list[str] = []
    _WORK.append(paths)
    try:
        yield
    finally:
        _WORK.remove(paths)
        for path in paths:
            release(spark, path)


#: Spark deletes a query's shuffle files when it ends, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lost
    executor costs a read, not the work before it. What its shuffles wrote goes."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    owners = _WORK[:-1] if keep else _WORK
    if owners:
        owners[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted``, each with underscores before it until no column of ``df`` has that name
    (in any case): for columns that are added for a while."""
    taken = {c.casefold() for c in df.columns}
    names = []
    for name in wanted:
        while name.casefold() in taken:
            name = f"_{name}"
        taken.add(name.casefold())
        names.append(name)
    return names


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    """How many parts a shuffle is dealt to, as the session sets it."""
    shipped(spark)
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
