"""Registered queries (name -> callable) and the SQL they are checked against."""

from triplens.registry import graph, tables, text, trends

_MODULES = (text, graph, trends, tables)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
