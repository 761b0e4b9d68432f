"""The operators as queries over the driver's tables, each with its SQL twin."""

from tallystream.workload import database, expressions, joins, late, layers, quarantine, streams, topics

_MODULES = (expressions, joins, topics, layers, streams, quarantine, late, database)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
