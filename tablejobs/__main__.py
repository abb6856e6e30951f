"""Command line: list, show or explain the registered jobs.

    python -m tablejobs list
    python -m tablejobs show group_count --sf-dir /root/testdata/sf0.01 -n 20
    python -m tablejobs explain fd_check
"""

from __future__ import annotations

import argparse
import sys

from tablejobs.jobs import JOBS, UNORDERED_LIMIT_JOBS
from tablejobs.oracle import ORACLE_SQL
from tablejobs.survey_map import ids_of_job


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tablejobs")
    parser.add_argument("command", choices=["list", "show", "explain"])
    parser.add_argument("job", nargs="?")
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    parser.add_argument("--master", default="local[8]")
    parser.add_argument("-n", type=int, default=20, help="rows to show")
    args = parser.parse_args(argv)

    if args.command == "list":
        for key in JOBS:
            oracle = "oracle" if key in ORACLE_SQL else "rows only"
            print(f"{key:24s}{oracle:11s}{' '.join(ids_of_job(key))}")
        return 0
    if args.job not in JOBS:
        parser.error(f"unknown job {args.job!r}; see 'list'")

    from tablejobs.plans import lint_plan, plan_text
    from tablejobs.session import build_session

    spark = build_session(args.master, 8, f"tablejobs-{args.job}")
    df = JOBS[args.job](spark, args.sf_dir)
    if args.command == "show":
        df.show(args.n, truncate=False)
    elif args.command == "explain":
        print(plan_text(df, "formatted"))
        report = lint_plan(df, allow_unordered_limit=args.job in UNORDERED_LIMIT_JOBS)
        print("scale checks:", "ok" if report.ok else report.problems)
    return 0


if __name__ == "__main__":
    sys.exit(main())
