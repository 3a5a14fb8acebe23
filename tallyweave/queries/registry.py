"""All registered queries and the SQL twins of those that SQL can express."""

from tallyweave.queries import audit_queries, measure_queries, name_queries, text_queries

_MODULES = [measure_queries, name_queries, text_queries, audit_queries]

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
