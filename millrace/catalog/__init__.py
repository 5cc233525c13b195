"""Reports and operators bound to the driver's test tables, each with an independent SQL check."""

from . import basics, ledger, loads, members, sessions, store

_PARTS = (basics, store, sessions, ledger, members, loads)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
