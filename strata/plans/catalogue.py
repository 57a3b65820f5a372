"""All core queries and their SQL twins."""

from __future__ import annotations

from strata.plans import operations, problems, problems_sql, reference, reference_sql

QUERIES = {**problems.QUERIES, **reference.QUERIES, **operations.QUERIES}
SQL = {**problems_sql.SQL, **reference_sql.SQL, **operations.SQL}
