"""Every operator and plan as a query over the test tables, with its SQL twin."""
from .base import REGISTRY
from . import aggregates, functions, incremental, joins, nft, ops, plans, quality, rows, sources, windows  # noqa: F401


def queries():
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}
