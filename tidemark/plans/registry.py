"""Name -> query and name -> oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.domain import Domain
from tidemark.plans.oracle import VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    """Register ``build(domain)`` under ``name`` with the SQL it must agree with."""

    def add(build: Callable[[Domain], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Domain(spark, sf_dir))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        ORACLES[name] = with_views(sql)
        return build

    return add


def with_views(sql: str) -> str:
    """Put the shared views that ``sql`` mentions in front of it, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(body)
                needed.append(name)

    visit(sql)
    body = sql.strip()
    views = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    if not views:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}"
