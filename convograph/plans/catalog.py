"""The registered queries of the engine's operators and their SQL twins."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from convograph.workers import ready

MODULES: tuple[str, ...] = ("texts", "flow", "graphs", "service", "stores", "resolution", "episodes", "scoring", "sets", "extractions", "loads", "validations", "storing", "merging", "themes", "summaries", "gaps", "routing", "analyses", "references")


def _with_workers(query: Callable) -> Callable:
    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(ready(spark), folder)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for name in MODULES:
        out |= {k: _with_workers(f) for k, f in importlib.import_module(f"convograph.plans.{name}").QUERIES.items()}
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for name in MODULES:
        out |= importlib.import_module(f"convograph.plans.{name}").SQL
    return out
