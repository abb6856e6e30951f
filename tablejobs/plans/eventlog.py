"""Task metrics from Spark's event log.

When a session writes its event log (``spark.eventLog.enabled`` with
``spark.eventLog.dir`` pointing at a scratch folder), every finished task is
recorded with its metrics. Spark flushes the log at each job end, so the
metrics of completed actions can be read while the application still runs.
This is how tests measure skew: the shuffle records each reduce task read.
"""

from __future__ import annotations

import glob
import json
import os
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass
class TaskRecord:
    stage_id: int
    task_id: int
    run_ms: int
    shuffle_records_read: int
    shuffle_bytes_read: int
    shuffle_records_written: int
    shuffle_bytes_written: int
    input_records: int


def event_log_path(spark: SparkSession) -> str | None:
    """The current application's event log (a file, or the folder of a rolling
    log), or None when logging is off. Readable while the application runs
    only when the log is uncompressed (``spark.eventLog.compress=false``)."""
    conf = spark.sparkContext.getConf()
    if conf.get("spark.eventLog.enabled", "false").lower() != "true":
        return None
    folder = conf.get("spark.eventLog.dir", "/tmp/spark-events").removeprefix("file:")
    app_id = spark.sparkContext.applicationId
    matches = sorted(glob.glob(os.path.join(folder, f"{app_id}*")) +
                     glob.glob(os.path.join(folder, f"eventlog_v2_{app_id}")))
    return matches[0] if matches else None


def _log_files(path: str) -> list[str]:
    if os.path.isdir(path):
        return sorted(glob.glob(os.path.join(path, "events_*")),
                      key=lambda p: int(os.path.basename(p).split("_")[1]))
    return [path]


def task_records(path: str, stage_ids: set[int] | None = None) -> list[TaskRecord]:
    """Finished tasks (optionally of some stages) with their shuffle metrics."""
    out = []
    for part in _log_files(path):
        if any(codec in os.path.basename(part) for codec in (".zstd", ".lz4", ".snappy", ".lzf")):
            raise ValueError(f"compressed event log {part}: set spark.eventLog.compress=false")
        out.extend(_read_tasks(part, stage_ids))
    return out


def settle(spark: SparkSession, timeout_ms: int = 10_000) -> bool:
    """Wait until Spark's listener bus has delivered every event so far. The
    event log and the job status store are filled by listeners, asynchronously,
    so a read right after an action may miss its last events otherwise.
    Returns False (after a short pause) when the bus cannot be waited on."""
    try:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(timeout_ms)
        return True
    except Exception:                       # internal API moved, or the wait timed out
        time.sleep(0.5)
        return False


def _read_tasks(path: str, stage_ids: set[int] | None) -> list[TaskRecord]:
    out = []
    with open(path) as fh:
        for line in fh:
            record = _task_record(line, stage_ids)
            if record is not None:
                out.append(record)
    return out


def _task_record(line: str, stage_ids: set[int] | None) -> TaskRecord | None:
    if '"SparkListenerTaskEnd"' not in line:
        return None
    try:
        event = json.loads(line)
    except json.JSONDecodeError:
        if not line.endswith("\n"):
            return None                         # the unfinished tail of a live log
        raise
    stage = event["Stage ID"]
    if stage_ids is not None and stage not in stage_ids:
        return None
    metrics = event.get("Task Metrics") or {}
    read = metrics.get("Shuffle Read Metrics") or {}
    write = metrics.get("Shuffle Write Metrics") or {}
    info = event.get("Task Info") or {}
    return TaskRecord(
        stage_id=stage,
        task_id=info.get("Task ID", -1),
        run_ms=metrics.get("Executor Run Time", 0),
        shuffle_records_read=read.get("Total Records Read", 0),
        shuffle_bytes_read=read.get("Remote Bytes Read", 0) + read.get("Local Bytes Read", 0),
        shuffle_records_written=write.get("Shuffle Records Written", 0),
        shuffle_bytes_written=write.get("Shuffle Bytes Written", 0),
        input_records=(metrics.get("Input Metrics") or {}).get("Records Read", 0),
    )


def stages_of_jobs(spark: SparkSession, job_ids: list[int]) -> set[int]:
    tracker = spark.sparkContext.statusTracker()
    stages: set[int] = set()
    for jid in job_ids:
        info = tracker.getJobInfo(jid)
        if info is not None:
            stages.update(info.stageIds)
    return stages
