"""Scale checks on a physical plan.

Reads the plan Spark would run (``explain`` text, before execution) and
reports shapes that stop scaling on a large cluster:

- broadcast or cartesian/nested-loop joins (sizes we have not bounded);
- row-at-a-time Python UDFs (``BatchEvalPython``);
- a hash or single-partition Exchange fed by raw rows instead of a partial
  aggregate (every row crosses the network; a hot key lands in one task;
  a single-partition gather puts the whole input in one task);
- a limit with no ordering (arbitrary rows), unless the caller allows it.

Explicit ``repartition`` calls and range exchanges of a global sort are
reported as facts, not as problems.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tablejobs.plans.inspect import plan_text

_FORBIDDEN = {
    "BroadcastExchange": "broadcast of a side whose size is not bounded",
    "BroadcastHashJoin": "broadcast join",
    "BroadcastNestedLoopJoin": "nested-loop join",
    "CartesianProduct": "cartesian product",
    "BatchEvalPython": "row-at-a-time Python UDF",
}
# A pre-aggregate feeding an Exchange: no functions (a distinct), or partial /
# merge steps (the map side of a plain or a distinct aggregate).
_PARTIAL = re.compile(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(keys?=\[[^\]]*\], "
                      r"functions=\[((partial_|merge_)[^\]]*|)\]")
_NODE = re.compile(r"^[\s:|+\-]*(?:\*\(\d+\)\s*)?([A-Za-z]+)")


@dataclass
class PlanReport:
    problems: list[str] = field(default_factory=list)
    exchanges: int = 0
    range_exchanges: int = 0
    explicit_repartitions: int = 0
    python_nodes: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.problems


def _node(line: str) -> str:
    m = _NODE.match(line)
    return m.group(1) if m else ""


# Nodes that keep the order of their input between a limit and its sort.
_ORDER_KEEPING = {"LocalLimit", "GlobalLimit", "CollectLimit", "Project", "Filter",
                  "ColumnarToRow", "InputAdapter", "WholeStageCodegen", "AdaptiveSparkPlan"}


def _single_partition_below(lines: list[str], j: int) -> bool:
    """Whether the input of the node at line ``j`` is one partition."""
    for line in lines[j + 1:]:
        name = _node(line)
        if name == "Coalesce" and re.search(r"Coalesce 1\b", line):
            return True
        if name == "Exchange":
            return "SinglePartition" in line
        if name not in _ORDER_KEEPING:
            return False
    return False


def _limit_is_ordered(lines: list[str], i: int) -> bool:
    """Whether the limit at line ``i`` takes rows in a defined order: from a
    global sort, a take-ordered, or a sort of a single partition."""
    for j in range(i + 1, len(lines)):
        name = _node(lines[j])
        if name in _ORDER_KEEPING:
            continue
        if name == "TakeOrderedAndProject":
            return True
        if name == "Sort":
            return "], true" in lines[j] or _single_partition_below(lines, j)
        return False
    return False


def lint_plan(df: DataFrame, allow_unordered_limit: bool = False) -> PlanReport:
    lines = [ln for ln in plan_text(df, "simple").splitlines() if ln.strip()]
    report = PlanReport()
    for i, line in enumerate(lines):
        name = _node(line)
        for bad, why in _FORBIDDEN.items():
            if name == bad:
                report.problems.append(f"{bad}: {why}")
        if name in ("MapInPandas", "FlatMapGroupsInPandas", "ArrowEvalPython", "MapInArrow"):
            report.python_nodes.append(name)
        if (name in ("CollectLimit", "GlobalLimit") and not allow_unordered_limit
                and not _limit_is_ordered(lines, i)):
            report.problems.append(f"{name} without an ordering returns arbitrary rows")
        if name != "Exchange":
            continue
        report.exchanges += 1
        if "REPARTITION_BY" in line:
            report.explicit_repartitions += 1
            continue
        if "rangepartitioning" in line:
            report.range_exchanges += 1
            continue
        child = lines[i + 1] if i + 1 < len(lines) else ""
        if ("hashpartitioning" in line or "SinglePartition" in line) and not _PARTIAL.search(child):
            kind = "single-partition gather" if "SinglePartition" in line else "hash shuffle"
            report.problems.append(f"{kind} of raw rows (no partial aggregate): {line.strip()}")
    return report
