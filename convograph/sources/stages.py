"""Stage tables: results of a stage as Parquet, by stage, with their fingerprint and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save(df: DataFrame, folder: str, stage: str) -> None:
    """Appends rows of a stage with the time and a digest of each row."""
    row = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    df.withColumns({"_digest": row, "_saved": F.current_timestamp()}).write.mode("append").parquet(f"{folder}/{stage}")


def load(spark: SparkSession, folder: str, stage: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(f"{folder}/{stage}")


def damaged(stage: DataFrame) -> DataFrame:
    """Rows whose digest no longer fits."""
    cols = [c for c in stage.columns if c not in ("_digest", "_saved")]
    return stage.where(F.sha2(F.to_json(F.struct(*cols)), 256) != F.col("_digest"))


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items that a stage has not done: repeating a job does nothing twice."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def latest(progress: DataFrame, item: str, stage: str, at: str, last: str) -> DataFrame:
    """Latest stage of each item that has not reached the last one."""
    return progress.groupBy(item).agg(F.max_by(stage, at).alias("stage"), F.max(at).alias("at")).where(F.col("stage") != last)


def retained(stage: DataFrame, days: int, now: str) -> DataFrame:
    return stage.where(F.col("_saved") >= F.lit(now).cast("timestamp") - F.expr(f"interval {days} days"))


def upgraded(stage: DataFrame) -> DataFrame:
    """Older stage rows in the present form: columns that came later get their defaults."""
    for name, default in (("extraction_mode", F.lit("fixed")), ("segment_index", F.lit(None).cast("int")), ("version", F.lit("3"))):
        if name not in stage.columns:
            stage = stage.withColumn(name, default)
    return stage


def export(spark: SparkSession, folder: str, names: list[str], items: DataFrame, key: str, to: str) -> None:
    """Writes the rows of some stages that belong to the items, by stage, to another folder, from which ``load`` reads them."""
    wanted = items.select(key).distinct()
    for name in names:
        load(spark, folder, name).join(wanted, key, "left_semi").write.mode("errorifexists").parquet(f"{to}/{name}")


def types_over_time(stage: DataFrame, kind: str) -> DataFrame:
    """(type, first, last, rows): when each type first and last came up in a stage."""
    return stage.groupBy(F.col(kind).alias("type")).agg(F.min("_saved").alias("first"), F.max("_saved").alias("last"), F.count("*").alias("rows"))
