"""DataFrame -> DataFrame operators, meant for ``df.transform`` chains."""

from tablejobs.operators.aggregate import (
    count_values, distinct_count, group_count, group_sum, having_count, row_count, stats_by,
)
from tablejobs.operators.compare import multiset_difference
from tablejobs.operators.fold import fold_any
from tablejobs.operators.ordering import distinct_rows, first_row, max_row, sort_by_position, top_n
from tablejobs.operators.quality import combos_per_key, fd_holds, fd_summary, fd_violations
from tablejobs.operators.relational import (
    convert_units, derive_dates, drop_cols, filter_eq, filter_like, rename, select_cols,
)
from tablejobs.operators.reuse import cached, checkpointed, held, narrow_to, spread, totals_by_each

__all__ = [
    "cached", "checkpointed", "combos_per_key", "convert_units", "count_values", "derive_dates",
    "distinct_count", "distinct_rows", "drop_cols", "fd_holds", "fd_summary",
    "fd_violations", "filter_eq", "filter_like", "first_row", "fold_any", "group_count", "group_sum",
    "having_count", "held", "max_row", "multiset_difference", "narrow_to", "rename", "row_count",
    "select_cols", "sort_by_position", "spread", "stats_by", "top_n", "totals_by_each",
]
