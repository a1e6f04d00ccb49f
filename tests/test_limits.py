"""Limits over streams with late rows: batches out of order, restarts, and state that leaves."""

import datetime as dt
import random

from convograph.streaming import limits

START = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp, k string, failed boolean"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def made():
    """Three files of events: within each and between them out of order by up to four minutes; the last closes the stream."""
    random.seed(3)
    times = sorted(random.randrange(0, 3000) for _ in range(150))
    rows = [(t, random.choice(["a", "b", None]), random.random() < 0.6) for t in times]
    late = sorted(rows, key=lambda r: r[0] + random.randrange(0, 240))
    return [late[:60], late[60:], [(90_000, "end", False)]]


def files(spark, folder, parts):
    for i, part in enumerate(parts):
        spark.createDataFrame([(at(t), k, f) for t, k, f in part], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        yield i


def drain(spark, stream, out, checkpoint):
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(150)
    assert q.exception() is None
    return q.lastProgress


def ordered(rows, processor):
    """The plain loop: each key's events in order of time."""
    known, out = {}, []
    for t, k, f in sorted(rows, key=lambda r: (r[0], r[2])):
        known[k], found = processor.step(known.get(k), t * 1_000_000, f)
        out.append((t, k or "", *found))
    return sorted(out, key=str)


def test_late_rows_restart_and_state(spark, tmp_path):
    parts = made()
    want = [r for p in parts[:2] for r in p]
    for name, build, processor, plain in (
        ("bucket", lambda s: limits.token_bucket(s, "k", 3, 0.05, late="5 minutes"), limits.Bucket(3, 0.05), [(t, k, False) for t, k, _ in want]),
        ("breaker", lambda s: limits.breaker(s, "k", "failed", failures=2, cool_down=90, late="5 minutes"), limits.Breaker(2, 90), want),
    ):
        src, out, mark = (str(tmp_path / f"{name}-{x}") for x in ("in", "out", "check"))
        for _ in files(spark, src, parts):  # each file is a run of its own: the query starts again from its checkpoint
            progress = drain(spark, build(spark.readStream.schema(SCHEMA).parquet(src)), out, mark)
        got = [(int((r.ts - START).total_seconds()), r.k or "", *(r[2:])) for r in spark.read.parquet(out).collect()]
        assert sorted((g for g in got if g[1] != "end"), key=str) == ordered(plain, processor), name
        left = sum(o.numRowsTotal for o in progress.stateOperators)
        if name == "bucket":  # full buckets are gone: what is left is the event that closes the stream and its timer
            assert left <= 4, left
