"""Named queries over the driver tables and end-to-end jobs."""

from .registry import ORACLE_SQL, OPERATORS, QUERIES  # noqa: F401


def load_all():
    """Import every query module so its ``@query`` registrations run."""
    from . import (alarm_queries, audit_queries, job_queries, ml_queries, order_queries,  # noqa: F401
                   record_queries, report_queries)
    return QUERIES, ORACLE_SQL
