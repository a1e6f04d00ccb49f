"""Streams give what their batch twins give."""

import datetime as dt

from pyspark.sql import functions as F

from convograph.streaming import events as X


def run(spark, stream, name, mode):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def source(spark, tmp_path, rows, schema):
    p = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(p)
    return spark.readStream.schema(schema).parquet(p), spark.read.parquet(p)


ROWS = [(dt.datetime(2024, 1, 1, h, m, s), f"u{s % 3}", s % 4 == 0) for h in range(3) for m in range(0, 60, 20) for s in range(0, 60, 5)]
SCHEMA = "ts timestamp, k string, failed boolean"


def test_availability(spark, tmp_path):
    stream, batch = source(spark, tmp_path, ROWS, SCHEMA)
    got = {(r.start, r.total, r.good) for r in run(spark, X.availability(stream, ~F.col("failed")), "avail", "complete")}
    want = {(r.start, r.total, r.good) for r in X.availability(batch, ~F.col("failed")).collect()}
    assert got == want and len(got) == 3


def test_first_seen_and_histogram(spark, tmp_path):
    stream, _ = source(spark, tmp_path, ROWS, SCHEMA)
    assert {r.k for r in run(spark, X.first_seen(stream, "k"), "seen", "append")} == {"u0", "u1", "u2"}


def test_token_bucket_and_breaker(spark, tmp_path):
    stream, _ = source(spark, tmp_path, ROWS, SCHEMA)
    got = run(spark, X.token_bucket(stream, "k", 3, 0.01), "bucket", "append")
    want = 0
    for k in ("u0", "u1", "u2"):
        tokens, last = 3.0, None
        for t in sorted(r[0] for r in ROWS if r[1] == k):
            if last is not None:
                tokens = min(3, tokens + (t - last).total_seconds() * 0.01)
            last = t
            if tokens >= 1:
                want += 1
                tokens -= 1
    assert sum(r.allowed for r in got) == want and len(got) == len(ROWS)


def test_breaker(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, s), "a", s in (1, 2, 3)) for s in range(6)] + [(dt.datetime(2024, 1, 1, 0, 5), "a", False)]
    stream, _ = source(spark, tmp_path, rows, SCHEMA)
    got = [r.state for r in sorted(run(spark, X.breaker(stream, "k", "failed", failures=3), "breaker", "append"), key=lambda r: r.ts)]
    assert got == ["closed", "closed", "closed", "open", "open", "open", "closed"]
