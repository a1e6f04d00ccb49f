"""Limits and breakers over streams whose rows come out of order, as stateful processors with timers.

A key's events wait in its state until the watermark has passed them and are then taken in order of time, so that a row that is late, but not too late,
changes what follows it as if it had come in time.  A key has one timer, at its earliest waiting event, or at the moment from which its state tells no more than
no state does; then the state leaves the store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from convograph.workers import ready

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: The store that keeps timers and several states a key.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class InOrder(StatefulProcessor):
    """Events of a key (``_at`` in microseconds, ``_flag``) in order of time once the watermark has passed them; of one time those without the flag come first."""

    #: Type of what is known of a key, and of what comes out for an event after key and time.
    known, out = "", ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at long, flag boolean", "n long")
        self.state = handle.getValueState("known", self.known)

    def step(self, known: tuple | None, at: int, flag: bool) -> tuple[tuple, tuple]:
        """What is known after an event, and what comes out for it."""
        raise NotImplementedError

    def until(self, known: tuple) -> int | None:
        """The time from which ``known`` is as good as nothing, if there is one."""
        raise NotImplementedError

    def _timer(self, at: int | None) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if at is not None:
            self.handle.registerTimer(-(-at // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        first = None
        for r in rows:
            k = (r["_at"], bool(r["_flag"]))
            n = self.waiting.getValue(k)[0] if self.waiting.containsKey(k) else 0
            self.waiting.updateValue(k, (n + 1,))
            first = k[0] if first is None else min(first, k[0])
        now = min(self.handle.listTimers(), default=None)
        # A timer of the state's end may come before the first event: it then finds events waiting and moves on to them.
        if first is not None and (now is None or -(-first // 1000) < now):
            self._timer(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        due, left = [], None
        for k in self.waiting.keys():
            if k[0] <= mark:
                due.append((k[0], k[1]))
            else:
                left = k[0] if left is None else min(left, k[0])
        known = tuple(self.state.get()) if self.state.exists() else None
        names = ["_key", "_at", *(c.split()[0] for c in self.out.split(", "))]
        for at, flag in sorted(due):
            for _ in range(self.waiting.getValue((at, flag))[0]):
                known, found = self.step(known, at, flag)
                yield Row(**dict(zip(names, (*key, at, *found), strict=True)))
            self.waiting.removeKey((at, flag))
        end = self.until(known) if known is not None else None
        if known is None or (end is not None and end <= mark):
            self.state.clear()
            end = None
        else:
            self.state.update(known)
        times = [t for t in (left, end) if t is not None]
        self._timer(min(times) if times else None)

    def close(self) -> None:
        pass


class Bucket(InOrder):
    known, out = "tokens double, last long", "allowed boolean, tokens double"

    def __init__(self, capacity: float, per_second: float):
        self.capacity, self.rate = float(capacity), float(per_second)

    def step(self, known, at, flag):
        tokens, last = known or (self.capacity, at)
        tokens = min(self.capacity, tokens + (at - last) / 1e6 * self.rate)
        allowed = tokens >= 1
        tokens -= 1.0 if allowed else 0.0
        return (tokens, at), (allowed, tokens)

    def until(self, known):
        """A full bucket is a new one."""
        return known[1] + int((self.capacity - known[0]) / self.rate * 1e6) + 1 if self.rate > 0 else None


class Breaker(InOrder):
    known, out = "now string, run long, since long", "state string"

    def __init__(self, failures: int, cool_down: float):
        self.failures, self.cool_down = failures, int(cool_down * 1e6)

    def step(self, known, at, flag):
        now, run, since = known or ("closed", 0, at)
        if now == "open" and at - since >= self.cool_down:
            now = "half_open"
        if now != "open":
            run = run + 1 if flag else 0
            if flag and (now == "half_open" or run >= self.failures):
                now, since = "open", at
            elif not flag:
                now = "closed"
        return (now, run, since), (now,)

    def until(self, known):
        """Closed without failures is how a breaker begins."""
        return 0 if known[0] == "closed" and known[1] == 0 else None


def stores(spark: SparkSession) -> SparkSession:
    """Takes the store that timers need, where the session has Spark's default one."""
    if not spark.conf.get(PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKS)
    return ready(spark)


def _in_order(stream: DataFrame, key: str, ts: str, flag, late: str, processor: InOrder) -> DataFrame:
    stores(stream.sparkSession)
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.where(F.col(ts).isNotNull()).withWatermark(ts, late).select(F.col(key).alias("_key"), ts, F.unix_micros(F.col(ts)).alias("_at"), F.coalesce(flag, F.lit(False)).alias("_flag"))
    found = rows.groupBy("_key").transformWithState(processor, f"_key {kind}, _at long, {processor.out}", "append", "EventTime")
    return found.select(F.col("_key").alias(key), F.timestamp_micros("_at").alias(ts), *found.columns[2:])


def token_bucket(stream: DataFrame, key: str, capacity: float, per_second: float, late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """(key, ts, allowed, tokens): a bucket for each key that refills with event time, over events in order of time.

    Events come out once the watermark (``late`` behind the latest) has passed them; later ones are dropped, as are those without a time.  A bucket leaves the state when it is full
    again, which no result depends on; a null key is a key."""
    return _in_order(stream, key, ts, F.lit(False), late, Bucket(capacity, per_second))


def breaker(stream: DataFrame, key: str, failed: str, failures: int = 5, cool_down: float = 60.0, late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """(key, ts, state): closed until ``failures`` in a row, then open for ``cool_down`` seconds, then half-open until the next outcome, over events in order of time.

    Events come out once the watermark has passed them, as in ``token_bucket``; a null outcome is no failure, and of one time those that did not fail come first.  A breaker that is closed without failures leaves the state."""
    return _in_order(stream, key, ts, F.col(failed), late, Breaker(failures, cool_down))
