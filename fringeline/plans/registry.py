"""How a module of queries registers them."""

from __future__ import annotations

from collections.abc import Callable

from fringeline.plans.views import oracle


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        """Register a query (spark, sf_dir) under its function's name, with its oracle."""

        def add(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = oracle(sql)
            return f

        return add
