"""All queries of the core, with their SQL."""

from plumbline.plans import decision_queries, function_queries, more_queries, page_queries, problem_queries, relational_queries, unit_sql

_PARTS = (problem_queries, relational_queries, more_queries, function_queries, decision_queries, page_queries)
QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
ORACLES = {k: v for part in (*_PARTS, unit_sql) for k, v in part.ORACLES.items()}
