"""Every operator as a query over the given tables, with its equivalent SQL."""

from tillroll.registry import aggs, io, reports, rows

_MODULES = (reports, rows, aggs, io)

QUERIES = {key: query for module in _MODULES for key, query in module.QUERIES.items()}
ORACLES = {key: sql for module in _MODULES for key, sql in module.ORACLES.items()}
