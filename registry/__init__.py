"""Registered queries and the SQL that each is checked against.

A query may come without SQL (iterative or numeric-kernel work); `tests/`
checks those against brute force on small fixtures.
"""

from __future__ import annotations

import functools

from seriesloom.session import bound_tasks, ship_package

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship_package(spark)
            bound_tasks(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def load() -> None:
    """Import the modules that register."""
    from . import dataset, features, files, models, reports  # noqa: F401
