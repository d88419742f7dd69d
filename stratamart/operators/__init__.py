from stratamart.operators.calendar import date_dimension, date_dimension_for
from stratamart.operators.checks import (
    ConstraintError,
    DuplicateKeyError,
    assert_measures,
    assert_unique,
    check_constraints,
    constraint_measures,
    duplicate_keys,
)
from stratamart.operators.conform import active, conform, key_problems, rejected, sort_out
from stratamart.operators.keys import assign_surrogate_keys
from stratamart.operators.marts import branch_performance, monthly_sales, top_products
from stratamart.operators.merge import (
    insert_absent,
    latest_per_key,
    change_measures,
    merge_soft_delete,
    merge_upsert,
)
from stratamart.operators.star import (
    fact_rows,
    lookup_keys,
    orphaned_keys,
    shuffles_facts,
    unmatched_report,
)
from stratamart.operators.summaries import (
    active_deleted_summary,
    calendar_coverage,
    dimension_size,
    fact_totals,
    find_duplicates,
    latest_deleted,
    table_counts,
)

__all__ = [
    "ConstraintError",
    "DuplicateKeyError",
    "active",
    "active_deleted_summary",
    "assert_measures",
    "assert_unique",
    "assign_surrogate_keys",
    "branch_performance",
    "calendar_coverage",
    "check_constraints",
    "conform",
    "constraint_measures",
    "date_dimension",
    "date_dimension_for",
    "dimension_size",
    "duplicate_keys",
    "fact_rows",
    "fact_totals",
    "find_duplicates",
    "insert_absent",
    "latest_deleted",
    "latest_per_key",
    "lookup_keys",
    "change_measures",
    "merge_soft_delete",
    "merge_upsert",
    "monthly_sales",
    "orphaned_keys",
    "key_problems",
    "rejected",
    "sort_out",
    "shuffles_facts",
    "table_counts",
    "top_products",
    "unmatched_report",
]
