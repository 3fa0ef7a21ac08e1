"""DataFrame-to-DataFrame operators."""

from .calendar import add_date_parts, add_weekday_name
from .columns import add_columns, cast_columns, columns_of_kind, drop_columns, keep_columns, rename_columns, where
from .distinct import distinct_counts, distinct_estimates, distinct_sketches, merge_sketches
from .duplicates import drop_duplicates
from .joins import count_referenced, keep_referenced, merge
from .membership import flag_membership
from .nulls import drop_nulls, fill_nulls
from .performance import flag_rates, flag_totals, fold_totals, total_rates
from .profile import correlation, correlation_matrix, count_duplicates, describe, null_counts, numeric_stats
from .quality import quality_report
from .rows import first_rows, number_rows, slice_rows, union_rows

__all__ = [
    "add_columns",
    "add_date_parts",
    "add_weekday_name",
    "cast_columns",
    "columns_of_kind",
    "correlation",
    "correlation_matrix",
    "count_duplicates",
    "count_referenced",
    "describe",
    "distinct_counts",
    "distinct_estimates",
    "distinct_sketches",
    "drop_columns",
    "drop_duplicates",
    "drop_nulls",
    "fill_nulls",
    "first_rows",
    "flag_membership",
    "flag_rates",
    "flag_totals",
    "fold_totals",
    "keep_columns",
    "keep_referenced",
    "merge",
    "merge_sketches",
    "null_counts",
    "number_rows",
    "numeric_stats",
    "quality_report",
    "rename_columns",
    "slice_rows",
    "total_rates",
    "union_rows",
    "where",
]
