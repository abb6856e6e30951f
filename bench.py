"""Bench: the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each job is timed from DataFrame construction (so
schema inference and footer jobs count) to the end of its action: a ``noop``
sink for reads and queries, a real Parquet write for the writing jobs. One
warm-up run, then the median of $BENCH_REPEATS runs. Afterwards every
registered job runs once (``all_jobs``; off with BENCH_ALL_JOBS=0), and the
shuffle volume of each headline job is read from the run's event log. The CSV copy of lineitem
that the CSV jobs scan is written once, untimed, below the scratch root.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablejobs import jobs  # noqa: E402
from tablejobs.jobs import JOBS  # noqa: E402
from tablejobs.plans import job_ids_of  # noqa: E402
from tablejobs.plans.eventlog import event_log_path, stages_of_jobs, task_records  # noqa: E402
from tablejobs import operators as ops  # noqa: E402
from tablejobs.schemas import LINEITEM_DDL  # noqa: E402
from tablejobs.session import build_session, release_all, scratch_path, table_path  # noqa: E402
from tablejobs.sources import read_csv, read_parquet, write_csv, write_files  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
ALL_JOBS = os.environ.get("BENCH_ALL_JOBS", "1") == "1"


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    # Event log of this local run, for shuffle volumes (read after each job).
    log_dir = tempfile.mkdtemp(prefix="tablejobs-bench-eventlog-")
    spark = build_session(f"local[{CPUS}]", CPUS, "tablejobs-bench", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    lineitem_path = table_path(SF_DIR, "lineitem")
    csv_path = scratch_path(spark, "bench_lineitem_csv")
    write_csv(read_parquet(spark, lineitem_path), csv_path, "overwrite")

    def parquet_scan():
        noop(read_parquet(spark, lineitem_path, LINEITEM_DDL))

    def csv_scan_schema():
        noop(read_csv(spark, csv_path, header=True, schema=LINEITEM_DDL))

    def csv_scan_infer():
        noop(read_csv(spark, csv_path, header=True, infer_schema=True))

    write_path = scratch_path(spark, "bench_write")   # overwritten by every run

    def parquet_write():
        write_files(read_parquet(spark, lineitem_path, LINEITEM_DDL),
                    write_path, "parquet", "overwrite")

    def group_count():
        noop(jobs.group_count(spark, SF_DIR))

    def distinct_partkey():
        noop(ops.distinct_rows(read_parquet(spark, lineitem_path, LINEITEM_DDL), "l_partkey"))

    def group_count_three():
        noop(jobs.view_counts_coded(spark, SF_DIR))

    def consistency_check():
        noop(jobs.fd_check(spark, SF_DIR))

    def seven_steps():
        jobs.seven_steps(spark, SF_DIR)

    headline = {
        "parquet_scan": parquet_scan,
        "csv_scan_schema": csv_scan_schema,
        "csv_scan_infer": csv_scan_infer,
        "parquet_write": parquet_write,
        "group_count": group_count,
        "distinct_partkey": distinct_partkey,
        "group_count_three": group_count_three,
        "fd_check": consistency_check,
        "seven_steps": seven_steps,
    }
    def timed(fn):
        def run():
            start = time.perf_counter()
            fn()
            return time.perf_counter() - start
        return run

    timings, stages = {}, {}
    for name, fn in headline.items():
        fn()
        runs, ids = [], []
        for _ in range(REPEATS):            # job bookkeeping stays outside the timer
            ids, elapsed = job_ids_of(spark, timed(fn))
            runs.append(elapsed)
        timings[name] = round(statistics.median(runs), 4)
        stages[name] = stages_of_jobs(spark, ids)   # looked up while still retained

    # How much each headline job shuffled (map side), from the event log
    # (job_ids_of has already waited for the listener bus to drain).
    tasks = task_records(event_log_path(spark))
    shuffles = {}
    for name in headline:
        mine = [t for t in tasks if t.stage_id in stages[name]]
        shuffles[name] = {
            "records": sum(t.shuffle_records_written for t in mine),
            "bytes": sum(t.shuffle_bytes_written for t in mine),
            "max_task_records_read": max((t.shuffle_records_read for t in mine), default=0),
        }

    # Every registered job once (after the warm-ups above), noop sink.
    all_jobs = {}
    if ALL_JOBS:
        for name, job in JOBS.items():
            start = time.perf_counter()
            try:
                noop(job(spark, SF_DIR))
                all_jobs[name] = round(time.perf_counter() - start, 4)
            except Exception as exc:  # recorded, not hidden
                all_jobs[name] = f"error: {type(exc).__name__}"
    release_all(spark)             # this session's outputs and databases
    spark.stop()
    print(json.dumps({
        "metric": "sum_of_median_job_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "repeats": REPEATS,
        "shuffle": shuffles,
        "all_jobs": all_jobs,
    }))


if __name__ == "__main__":
    main()
