"""What the corpus operators share: worker set-up, column hygiene, scratch folders."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from convograph import workers


#: Rows of an Arrow batch: whole documents come in them, so Spark's default of 10000 would be many times a worker's other memory.
BATCH_ROWS = 1000
SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when it is not installed on them, see to a checkpoint folder, and make Arrow batches small where
    the session has Spark's default size."""
    workers.ready(spark)
    workers.checkpoints(spark)
    if spark.conf.get(SETTING) == "10000":
        spark.conf.set(SETTING, str(BATCH_ROWS))
    return spark


def released(result=None):
    """Gives memory that is free back to the system, and returns ``result``.

    Python workers outlive their tasks, and both Arrow and the C library hold on to what a task has freed: an executor would carry it
    through all later stages, those without Python too."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)
    return result


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of batches that gives memory back at its end."""

    def whole(batches):
        yield from run(batches)
        released()

    return whole


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{ready(spark).sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under private names; a null text is empty.

    A null id is kept and counts as larger than every other id; operators that compare ids read 2**63 - 1 as null, too."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))


def loose(kind: DataType) -> DataType:
    """The type with nulls allowed everywhere, as it comes back from Arrow."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, loose(f.dataType), True) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(loose(kind.elementType), True)
    if isinstance(kind, MapType):
        return MapType(kind.keyType, loose(kind.valueType), True)
    return kind


def packed(docs: DataFrame, columns: list[str]):
    """The columns in one struct, which names inside an operator cannot clash with."""
    kind = StructType([docs.schema[c] for c in columns])
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]).cast(loose(kind))


def schema(name: str, kind: DataType, rest: str) -> StructType:
    """A column of any name and type before those of ``rest``."""
    return StructType([StructField(name, loose(kind)), *StructType.fromDDL(rest).fields])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(column):
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
