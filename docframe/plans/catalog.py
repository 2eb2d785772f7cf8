"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from docframe.plans import fragments, invoices, layouts, markdown, responses, runs

MODULES = (invoices, markdown, fragments, responses, layouts, runs)


def queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
