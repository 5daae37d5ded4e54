"""Registered queries with the SQL that states the same result."""

from corvane.plans import (  # noqa: F401  (importing registers the queries)
    class_plans,
    matrix_plans,
    source_plans,
    text_plans,
    vector_plans,
)
from corvane.plans.registry import oracle_sql, queries  # noqa: F401
