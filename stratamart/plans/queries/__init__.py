"""One query per operator over the driver's tables, each with the SQL that must give the same rows."""

from stratamart.plans.queries import cleaning, merging, reports, runs, star
from stratamart.plans.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "cleaning", "merging", "reports", "runs", "star"]
