"""Plan inspection helpers (explain text, node counts, job counts)."""

from tablejobs.plans.inspect import count_nodes, exchanges, job_ids_of, jobs_started, plan_text

__all__ = ["count_nodes", "exchanges", "job_ids_of", "jobs_started", "plan_text"]

from tablejobs.plans.lint import PlanReport, lint_plan  # noqa: E402

__all__ += ["PlanReport", "lint_plan"]
