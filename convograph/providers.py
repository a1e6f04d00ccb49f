"""Seams for models and extraction: providers by name, deterministic stand-ins, strategies and switches."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from convograph.operators.entities import mock_embedding


class Registry:
    """Makers of providers by (kind, name); the latest version of a name is the default."""

    def __init__(self):
        self._makers: dict[tuple[str, str], dict[str, Callable]] = {}

    def register(self, kind: str, name: str, version: str = "1.0"):
        def put(maker: Callable) -> Callable:
            self._makers.setdefault((kind, name), {})[version] = maker
            return maker

        return put

    def create(self, kind: str, name: str, version: str | None = None, **options):
        versions = self._makers.get((kind, name))
        if not versions or (version and version not in versions):
            raise ValueError(f"no {kind} provider {name} {version or ''}".rstrip())
        return versions[version or max(versions)](**options)

    def names(self, kind: str) -> list[str]:
        return sorted(n for k, n in self._makers if k == kind)


registry = Registry()


@registry.register("llm", "echo")
def echo_llm():
    """Answers a prompt with a JSON object about it."""
    return lambda prompt: json.dumps({"entities": [], "length": len(prompt), "digest": hashlib.md5(prompt.encode()).hexdigest()[:8]}, sort_keys=True)


@registry.register("embedding", "digest")
def digest_embedding(dimension: int = 16):
    """Unit vectors from the digest of a text, as a column function."""
    return lambda column: mock_embedding(column, dimension)


def complete(df: DataFrame, prompt: str, llm: Callable[[str], str], out: str = "answer") -> DataFrame:
    """Adds the answers of a model; equal prompts are asked once for each batch."""

    @F.pandas_udf(StringType())
    def ask(p: pd.Series) -> pd.Series:
        known = {x: llm(x) for x in p.dropna().unique()}
        return pd.Series([known.get(x) for x in p], dtype=object)

    return df.withColumn(out, ask(F.col(prompt)))


POOLING = ("mean", "max", "cls")


def embed(df: DataFrame, text: str, model: Callable[[list[str]], list[list[float]]], out: str = "embedding", batch: int = 50, pooling: str = "mean") -> DataFrame:
    """Adds vectors of a model that takes lists of texts; ``pooling`` must be a name the model knows, and is its own affair."""
    if pooling not in POOLING:
        raise ValueError(f"unknown pooling {pooling}; one of {', '.join(POOLING)}")

    @F.pandas_udf(ArrayType(DoubleType()))
    def run(t: pd.Series) -> pd.Series:
        return pd.Series([v for i in range(0, len(t), batch) for v in model(t.iloc[i : i + batch].fillna("").tolist())], dtype=object)

    return df.withColumn(out, run(F.col(text)))


def flag(spark: SparkSession, name: str, default: bool = False) -> bool:
    """A switch of the session: ``convograph.flag.<name>``."""
    return spark.conf.get(f"convograph.flag.{name}", str(default)).lower() in ("true", "1", "yes", "on")


def combined(fixed: DataFrame, free: DataFrame, key: str = "name") -> DataFrame:
    """Rows of the fixed extraction, and those of the free one whose key it lacks, in any case."""
    k = F.lower(F.trim(key))
    rest = free.withColumn("_k", k).join(fixed.select(k.alias("_k")).distinct(), "_k", "left_anti").drop("_k")
    return fixed.unionByName(rest.select(fixed.columns))


STRATEGIES: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {"fixed": lambda a, b: a, "schemaless": lambda a, b: b, "dual": combined, "migration": combined}


def strategy(mode: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    if mode not in STRATEGIES:
        raise ValueError(f"unknown mode {mode}; one of {', '.join(STRATEGIES)}")
    return STRATEGIES[mode]


class Prompts:
    """Templates of prompts by name and version, filled with columns: ``{name}`` stands for a column, null for nothing."""

    def __init__(self):
        self._texts: dict[str, dict[str, str]] = {}

    def register(self, name: str, text: str, version: str = "1.0") -> None:
        self._texts.setdefault(name, {})[version] = text

    def versions(self, name: str) -> list[str]:
        return sorted(self._texts.get(name, {}))

    def build(self, name: str, version: str | None = None, /, **columns: Column) -> Column:
        """The latest version unless one is named.  What a column holds is never read as a placeholder."""
        texts = self._texts.get(name)
        if not texts or (version and version not in texts):
            raise ValueError(f"no prompt {name} {version or ''}".rstrip())
        parts = re.split(r"\{(\w+)\}", texts[version or max(texts)])
        if missing := sorted({p for p in parts[1::2]} - set(columns)):
            raise ValueError(f"prompt {name} needs {', '.join(missing)}")
        return F.concat(*[F.coalesce(columns[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def settings(path: str, defaults: dict | None = None) -> dict:
    """Settings of a JSON file, or of a YAML file by its ending, over the defaults; what the file does not name keeps its default, names that the defaults lack are an error.

    An empty YAML file names nothing; YAML needs PyYAML where the driver runs."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"no settings at {path}")
    with open(path, encoding="utf-8") as f:
        if path.lower().endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError(f"PyYAML is not installed, so {path} cannot be read") from e
            found = yaml.safe_load(f)
            found = {} if found is None else found
        else:
            found = json.load(f)
    if not isinstance(found, dict):
        raise ValueError("settings are an object of names and values")
    if defaults is not None and (unknown := sorted(set(found) - set(defaults))):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return {**(defaults or {}), **found}


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that holds their number once an action has run: the impact of a step without another pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
