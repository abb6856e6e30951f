"""Session and shared scratch space.

Jobs that write files (round trips, tables, the staged write) put their output
under the folder the cluster names in ``spark.checkpoint.dir``: that folder is
shared by every executor and survives the loss of any one of them. The setting
is read from the running session; only when it is unset (local tests, the
bench) is a folder of our own set, once per session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tablejobs", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench (a cluster brings its own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set locally only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares; "
                               "a driver-local folder is only usable with a local master")
        configured = tempfile.mkdtemp(prefix="tablejobs-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def session_scratch(spark: SparkSession) -> str:
    """This session's own folder below the shared scratch root. Sessions that
    share a SparkContext (notebooks, ``newSession``) share the checkpoint
    folder; the session's fixed id, assigned by Spark, separates them."""
    session_id = str(spark._jsparkSession.sessionUUID()).replace("-", "")
    return f"{scratch_root(spark)}/tablejobs/{session_id}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused location in this session's scratch folder."""
    return f"{session_scratch(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """Catalog-safe unique identifier (views, databases)."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def name_fold(spark: SparkSession):
    """How Spark compares column names in this session."""
    return (lambda name: name) if case_sensitive(spark) else str.casefold


def ensure_unique_columns(df):
    """``df`` itself, or a ValueError when two of its columns share a name
    (as Spark compares names): checked on the analysed result, no job runs."""
    fold = name_fold(df.sparkSession)
    seen: set[str] = set()
    for column in df.columns:
        key = fold(column)
        if key in seen:
            raise ValueError(f"result would have two columns named {column!r}")
        seen.add(key)
    return df


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) of ``path`` through the session's Hadoop config
    (including file-system settings made on this session), so file operations
    work on whatever file system the cluster uses."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hpath.getFileSystem(conf), hpath


def release_all(spark: SparkSession) -> bool:
    """Delete everything this session's jobs wrote and drop the databases they
    created there. Other sessions, even on the same SparkContext, keep theirs.
    Call it when the work is done (the tests and the bench do); DataFrames
    reading those outputs stop working. Spark's own RDD checkpoint data is
    left to Spark's cleaner settings."""
    folder = session_scratch(spark)
    current = spark.catalog.currentDatabase()
    for db in spark.catalog.listDatabases("db_*"):       # the names new_database gives
        if (db.locationUri or "").startswith(folder + "/"):
            if db.name == current:
                spark.catalog.setCurrentDatabase("default")
            spark.sql(f"DROP DATABASE IF EXISTS `{db.name}` CASCADE")
    fs, hpath = hadoop_fs(spark, folder)
    return bool(fs.delete(hpath, True))


def release(spark: SparkSession, path: str) -> bool:
    """Delete one job output in this session's scratch folder.

    Round-trip and sink jobs leave their files there so the DataFrames they
    return stay readable; call this once a result is no longer needed. Goes
    through the Hadoop FileSystem API, so it works on any cluster file system,
    and refuses every path outside the folder (and the folder itself)."""
    base = f"{session_scratch(spark)}/"
    parts = path[len(base):].split("/") if path.startswith(base) else []
    if not parts or any(p in ("", ".", "..") for p in parts):
        raise ValueError(f"{path!r} is not one output below {base!r}")
    fs, hpath = hadoop_fs(spark, path)
    return bool(fs.delete(hpath, True))
