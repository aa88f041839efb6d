"""Named queries (one per operator of the survey's inventory) and, where the
result is expressible in SQL, the independent DuckDB oracle for each.

Every query starts from the given parquet tables (through the bank view or
directly) and runs over whole tables. Doubles are rounded to 6 places on
both sides so engine-level summation order does not show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registries
    from tessera.plans import (q_profile, q_clean, q_features, q_combine, q_split, q_score, q_model, q_io,  # noqa: F401
                               q_project, q_entry)
