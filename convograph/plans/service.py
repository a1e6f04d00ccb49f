"""Queries over events: metrics, service levels, limits."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from convograph.operators import service as S
from convograph.plans.base import Book, n, r6, table
from convograph.sources import stages
from convograph.workers import checkpoints

book = Book()


def events(spark, sf):
    return table(spark, sf, "events")


@book.add("""WITH o AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type, max(value) FILTER (WHERE i = least(floor(n * 50 / 100), n - 1)) AS p50, max(value) FILTER (WHERE i = least(floor(n * 95 / 100), n - 1)) AS p95, max(value) FILTER (WHERE i = least(floor(n * 99 / 100), n - 1)) AS p99 FROM o GROUP BY 1""")
def latency_percentiles(spark, sf):
    return S.percentiles(events(spark, sf), ["event_type"], "value", [50, 95, 99])


@book.add("SELECT event_type, le::DOUBLE AS le, CAST(count(*) FILTER (WHERE value <= le) AS BIGINT) AS count FROM events, (SELECT unnest([0.1, 0.5, 1, 5, 10, 30, 60, 120, 300]) AS le) GROUP BY 1, 2")
def histogram_buckets(spark, sf):
    return S.histogram(events(spark, sf), ["event_type"], "value")


@book.add("""WITH g AS (SELECT user_id % 10 AS shard, count(*) AS total, count(*) FILTER (WHERE event_type <> 'error') AS good FROM events GROUP BY 1), c AS (SELECT *, (total - good) / (total * (1 - 70 / 100.0::DOUBLE)) * 100 AS consumed FROM g)
SELECT shard, total, good, total - good AS bad, round(consumed, 6) AS consumed_percent, round(43200 * (1 - 70 / 100.0::DOUBLE) * consumed / 100, 6) AS consumed_minutes, round(greatest(0, 43200 * (1 - 70 / 100.0::DOUBLE) - 43200 * (1 - 70 / 100.0::DOUBLE) * consumed / 100), 6) AS remaining_minutes, CASE WHEN greatest(0, 100 - consumed) < 10 THEN 'critical' WHEN greatest(0, 100 - consumed) < 20 THEN 'warning' ELSE 'healthy' END AS status FROM c""")
def error_budgets(spark, sf):
    e = events(spark, sf).withColumn("shard", F.col("user_id") % 10)
    b = S.error_budget(e, ["shard"], (F.col("event_type") != "error"), 70.0, 43200)
    return b.select("shard", "total", "good", "bad", *[r6(F.col(c)).alias(c) for c in ("consumed_percent", "consumed_minutes", "remaining_minutes")], "status")


@book.add("""SELECT length, strftime(start, '%Y-%m-%d %H:%M') AS start, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS bad, round(count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS burn_rate
FROM (SELECT '1h' AS length, time_bucket(INTERVAL 1 hour, ts) AS start, event_type FROM events UNION ALL SELECT '6h', time_bucket(INTERVAL 6 hour, ts, TIMESTAMP '1970-01-01'), event_type FROM events UNION ALL SELECT '24h', time_bucket(INTERVAL 24 hour, ts, TIMESTAMP '1970-01-01'), event_type FROM events) GROUP BY 1, 2""")
def burn_rates(spark, sf):
    g = S.windowed_rates(events(spark, sf), "ts", (F.col("event_type") == "error"), {"1h": "1 hour", "6h": "6 hours", "24h": "24 hours"})
    return g.select("length", F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "total", "bad", r6(F.col("burn_rate")).alias("burn_rate"))


@book.add("""WITH w AS (SELECT event_id, count(*) OVER (PARTITION BY user_id % 50 ORDER BY epoch(ts)::BIGINT RANGE BETWEEN 3599 PRECEDING AND 0 FOLLOWING) AS h, count(*) OVER (PARTITION BY user_id % 50 ORDER BY epoch(ts)::BIGINT RANGE BETWEEN 86399 PRECEDING AND 0 FOLLOWING) AS d FROM (SELECT *, date_trunc('second', ts) AS t2 FROM events)) SELECT event_id, h AS in_hour, d AS in_day, h > 1 OR d > 8 AS limited FROM w""")
def rate_limits(spark, sf):
    e = events(spark, sf).withColumns({"key": F.col("user_id") % 50, "sec": F.timestamp_seconds(F.round(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000))})
    return S.over_limit(e, "key", "sec", {3600: 1, 86400: 8}).select("event_id", F.col("in_3600s").alias("in_hour"), F.col("in_86400s").alias("in_day"), "limited")


@book.add("""WITH e AS (SELECT event_id, user_id % 20 AS k, ts, event_type <> 'error' AS ok FROM events), m AS (SELECT *, CASE WHEN ok = lag(ok) OVER (PARTITION BY k ORDER BY ts, event_id) THEN 0 ELSE 1 END AS nw FROM e), r AS (SELECT *, sum(nw) OVER (PARTITION BY k ORDER BY ts, event_id) AS run FROM m), s AS (SELECT *, row_number() OVER (PARTITION BY k, run ORDER BY ts, event_id) AS streak FROM r) SELECT event_id, streak, CASE WHEN NOT ok AND streak >= 3 THEN 'open' ELSE 'closed' END AS state FROM s""")
def circuit_states(spark, sf):
    e = events(spark, sf).withColumn("k", F.col("user_id") % 20)
    return S.circuit(e, "k", ["ts", "event_id"], (F.col("event_type") != "error"), failures=3).select("event_id", n(F.col("streak")).alias("streak"), "state")


@book.add("SELECT event_id, round(sum(value) OVER w, 4) AS sum_100, count(*) OVER w AS n_100 FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)")
def health_latency(spark, sf):
    w = Window.partitionBy("event_type").orderBy("ts", "event_id").rowsBetween(-99, 0)
    return events(spark, sf).select("event_id", F.round(F.sum("value").over(w), 4).alias("sum_100"), F.count("*").over(w).alias("n_100"))


@book.add("SELECT event_type, CAST(count(*) AS BIGINT) AS samples, round(sum(value), 6) AS total, round(avg(value), 6) AS mean, min(value) AS least, max(value) AS most, arg_max(value, (ts, event_id)) AS latest FROM events GROUP BY 1")
def metric_summary(spark, sf):
    return events(spark, sf).groupBy("event_type").agg(F.count("*").alias("samples"), r6(F.sum("value")).alias("total"), r6(F.avg("value")).alias("mean"), F.min("value").alias("least"), F.max("value").alias("most"), F.max_by("value", F.struct("ts", "event_id")).alias("latest"))


@book.add("SELECT '# TYPE ' || event_type || '_total counter' AS head, event_type || '_total{source=\"events\"} ' || CAST(count(*) AS VARCHAR) AS sample FROM events GROUP BY event_type")
def prometheus_text(spark, sf):
    return events(spark, sf).groupBy("event_type").agg(F.count("*").alias("c")).select(F.concat(F.lit("# TYPE "), "event_type", F.lit("_total counter")).alias("head"), F.format_string('%s_total{source="events"} %d', "event_type", "c").alias("sample"))


@book.add("WITH g AS (SELECT event_type, avg(value) FILTER (WHERE event_id % 2 = 0) AS now, avg(value) FILTER (WHERE event_id % 2 = 1) AS base FROM events GROUP BY 1) SELECT event_type, round((now - base) / base * 100, 6) AS change, CASE WHEN (now - base) / base * 100 > 1 THEN 'regressed' WHEN (now - base) / base * 100 < -1 THEN 'improved' ELSE 'unchanged' END AS verdict FROM g")
def baseline_comparison(spark, sf):
    e = events(spark, sf)
    half = lambda k: e.where(F.col("event_id") % 2 == k).groupBy("event_type").agg(F.avg("value").alias("v"))
    return S.compare(half(0), half(1), "event_type", "v", 1.0).select("event_type", r6(F.col("change")).alias("change"), "verdict")


@book.add("WITH f AS (SELECT event_type, min(ts) AS first, max(ts) AS last, count(*) AS uses FROM events GROUP BY 1) SELECT event_type, strftime(first, '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(last, '%Y-%m-%d %H:%M:%S') AS last_seen, uses, round(uses / sum(uses) OVER (), 6) AS share, CAST(row_number() OVER (ORDER BY first, event_type) AS BIGINT) AS nth, row_number() OVER (ORDER BY uses DESC, event_type) <= 10 AS common FROM f")
def schema_evolution(spark, sf):
    """Kinds in order of their discovery, and whether they are among the ten most common; the windows run over one row a kind."""
    f = events(spark, sf).groupBy("event_type").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("uses"))
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return f.select("event_type", fmt("first").alias("first_seen"), fmt("last").alias("last_seen"), "uses", r6(F.col("uses") / F.sum("uses").over(Window.partitionBy())).alias("share"), n(F.row_number().over(Window.orderBy("first", "event_type"))).alias("nth"), (F.row_number().over(Window.orderBy(F.desc("uses"), "event_type")) <= 10).alias("common"))


@book.add("WITH h AS (SELECT user_id % 10 AS provider, avg((event_type <> 'error')::INT) AS ok, count(*) AS n FROM events GROUP BY 1), s AS (SELECT count(*) FILTER (WHERE ok >= 0.8) / count(*) AS share FROM h) SELECT round(share, 6) AS share, CASE WHEN share >= 0.8 THEN 'healthy' WHEN share >= 0.5 THEN 'degraded' ELSE 'critical' END AS status FROM s")
def aggregate_health(spark, sf):
    h = events(spark, sf).groupBy((F.col("user_id") % 10).alias("provider")).agg(F.avg((F.col("event_type") != "error").cast("double")).alias("ok"))
    s = h.agg((F.count_if(F.col("ok") >= 0.8) / F.count("*")).alias("share"))
    return s.select(r6(F.col("share")).alias("share"), F.when(F.col("share") >= 0.8, "healthy").when(F.col("share") >= 0.5, "degraded").otherwise("critical").alias("status"))


@book.add("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS entities, round(least(1.0, CAST(json_extract(props, '$.k') AS BIGINT) / 5), 6) AS quality FROM events")
def extraction_quality(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    return events(spark, sf).select("event_id", k.alias("entities"), r6(F.least(F.lit(1.0), k / 5)).alias("quality"))


@book.add("WITH s AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS stage, count(*) AS steps FROM events GROUP BY 1) SELECT stage, CAST(count(*) AS BIGINT) AS open_items FROM s WHERE stage <> 'purchase' GROUP BY 1")
def incomplete_items(spark, sf):
    s = events(spark, sf).groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("stage"))
    return s.where("stage <> 'purchase'").groupBy("stage").agg(F.count("*").alias("open_items"))


@book.add("SELECT quality, toxic, CAST(count(*) AS BIGINT) AS docs, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels GROUP BY 1, 2")
def label_quality(spark, sf):
    g = table(spark, sf, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("docs"))
    return g.select("quality", "toxic", "docs", r6(F.col("docs") / F.sum("docs").over(Window.partitionBy())).alias("share"))


@book.add("""WITH d AS (SELECT doc_id, coalesce(source, '') AS source, doc_id IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) AS done, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS moved FROM documents)
SELECT source, CAST(count(*) FILTER (WHERE done) AS BIGINT) AS done, CAST(count(*) FILTER (WHERE NOT done) AS BIGINT) AS pending, CAST(0 AS BIGINT) AS damaged, CAST(count(*) FILTER (WHERE done) AS BIGINT) AS retained, CAST(count(*) FILTER (WHERE moved) AS BIGINT) AS moved, CAST(count(*) FILTER (WHERE moved) AS BIGINT) AS upgraded FROM d GROUP BY 1""")
def staged_documents(spark, sf):
    """A stage table from end to end: labelled documents are saved as done, read back, checked against their digests and retained for a day; what is not there is
    pending; the toxic ones are exported to another folder and brought to the present form."""
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    labels = table(spark, sf, "labels")
    at = f"{checkpoints(spark).sparkContext.getCheckpointDir()}/stages-{uuid.uuid4().hex}"
    stages.save(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), at, "texts")
    done = stages.load(spark, at, "texts")
    stages.export(spark, at, ["texts"], labels.where("toxic = 1"), "doc_id", f"{at}-moved")
    moved = stages.load(spark, f"{at}-moved", "texts")
    now = spark.sql("SELECT string(current_timestamp())").first()[0]
    parts = {"done": done, "pending": stages.pending(docs, done, "doc_id"), "damaged": stages.damaged(done), "retained": stages.retained(done, 1, now), "moved": moved, "upgraded": stages.upgraded(moved).where("version = '3' AND extraction_mode = 'fixed'")}
    rows = docs.select("source").distinct()
    for name, part in parts.items():
        rows = rows.join(part.groupBy("source").agg(F.count("*").alias(name)), "source", "left")
    return rows.select("source", *[F.coalesce(name, F.lit(0)).alias(name) for name in parts])


QUERIES, SQL = book.queries, book.sql
