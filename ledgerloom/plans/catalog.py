"""All named queries of the core and their SQL counterparts."""

from __future__ import annotations

from ledgerloom.plans import problems, reference, reference_sql

FLAGSHIP = "issue_catalogue"
QUERIES = {**problems.QUERIES, **reference.QUERIES}
SQL = {**problems.SQL, **reference_sql.SQL}
