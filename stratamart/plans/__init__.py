from stratamart.plans.jobs import (
    LoadError,
    Report,
    Step,
    create_tables,
    load_balance,
    reject_report,
    rejected_rows,
    run_landing,
    run_service,
    run_staging,
    run_warehouse,
    service_summary,
    staging_summary,
    unmatched_facts,
)
from stratamart.plans.retail import RETAIL

__all__ = [
    "RETAIL",
    "LoadError",
    "Report",
    "Step",
    "create_tables",
    "load_balance",
    "reject_report",
    "rejected_rows",
    "run_landing",
    "run_service",
    "run_staging",
    "run_warehouse",
    "service_summary",
    "staging_summary",
    "unmatched_facts",
]
