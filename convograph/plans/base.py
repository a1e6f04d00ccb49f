"""How queries and their SQL twins are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Book:
    """Queries of one theme.  ``sql`` is None where SQL has no form of the operator."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def put(f):
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return put


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(c: Column) -> Column:
    return F.round(c.cast("double"), 6)


def n(c: Column) -> Column:
    return c.cast("long")


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(values) -> str:
    """A list of strings in SQL."""
    return "[" + ", ".join(quote(v) for v in values) + "]"


def sql_words(text: str = "text") -> str:
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda w: w <> '')"


def sql_plain(text: str = "text") -> str:
    return rf"regexp_replace({text}, '[^\x00-\x7F]', '_', 'g')"


def sql_matches(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {quote('(?i)' + pattern)}))"


def sql_total(text: str, patterns) -> str:
    return "(" + " + ".join(sql_matches(text, p) for p in (patterns.values() if isinstance(patterns, dict) else patterns)) + ")"


def sql_any(text: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({text}, {quote(p)})" for p in phrases) + ")"


def sql_how_many(text: str, phrases) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, {quote(p)}) AS INT)" for p in phrases) + ")"
