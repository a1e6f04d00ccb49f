"""Structured Streaming forms of the service operators.

Each takes a stream of (ts, ...) and returns a streaming DataFrame; on the same rows they give what
their batch twins give, late rows beyond the watermark aside."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from convograph.operators import service as S


def availability(stream: DataFrame, good: Column, length: str = "1 hour", slide: str | None = None, late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Share of good events in windows; a window is final once the watermark has passed it."""
    g = stream.withWatermark(ts, late).groupBy(F.window(ts, length, slide) if slide else F.window(ts, length)).agg(F.count("*").alias("total"), F.count_if(good).alias("good"))
    return g.select(F.col("window.start").alias("start"), "total", "good", (F.col("good") / F.col("total")).alias("availability"))


def histogram(stream: DataFrame, group: list[str], value: str, bounds: list[float] | None = None) -> DataFrame:
    """Running cumulative buckets (update or complete mode)."""
    return S.histogram(stream, group, value, bounds)


def first_seen(stream: DataFrame, kind: str, late: str = "1 day", ts: str = "ts") -> DataFrame:
    """Each kind once, when it first comes within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([kind]).select(kind, ts)


def token_bucket(stream: DataFrame, key: str, capacity: float, per_second: float, ts: str = "ts") -> DataFrame:
    """(key, ts, allowed, tokens): a bucket for each key that refills with event time."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tokens, last = state.get if state.exists else (float(capacity), None)
        for f in frames:
            out = []
            for t in sorted(f[ts]):
                at = t.timestamp()
                if last is not None:
                    tokens = min(capacity, tokens + max(0.0, at - last) * per_second)
                last = at
                allowed = tokens >= 1
                tokens -= 1.0 if allowed else 0.0
                out.append((k[0], t, allowed, tokens))
            yield pd.DataFrame(out, columns=[key, ts, "allowed", "tokens"])
        state.update((tokens, last))

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {ts} timestamp, allowed boolean, tokens double", "tokens double, last double", "append", GroupStateTimeout.NoTimeout)


def breaker(stream: DataFrame, key: str, failed: str, failures: int = 5, cool_down: float = 60.0, ts: str = "ts") -> DataFrame:
    """(key, ts, state): closed until ``failures`` in a row, then open for ``cool_down`` seconds, then half-open until the next outcome."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, run, since = state.get if state.exists else ("closed", 0, 0.0)
        for f in frames:
            out = []
            for t, bad in sorted(zip(f[ts], f[failed], strict=True)):
                at = t.timestamp()
                if now == "open" and at - since >= cool_down:
                    now = "half_open"
                if now != "open":
                    run = run + 1 if bad else 0
                    if bad and (now == "half_open" or run >= failures):
                        now, since = "open", at
                    elif not bad:
                        now = "closed"
                out.append((k[0], t, now))
            yield pd.DataFrame(out, columns=[key, ts, "state"])
        state.update((now, run, since))

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {ts} timestamp, state string", "now string, run int, since double", "append", GroupStateTimeout.NoTimeout)
