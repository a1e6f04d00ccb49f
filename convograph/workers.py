"""What every session needs: workers that can import this package, and a folder for checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ready(spark: SparkSession) -> SparkSession:
    """Puts the package's folder on the path of workers that start from now on."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, env.get("PYTHONPATH", "")) if p)
    return spark


def checkpoints(spark: SparkSession) -> SparkSession:
    """Uses the shared folder that ``spark.checkpoint.dir`` names.  Only a local session, whose executors are the driver, may do without one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="convograph-"))
    return spark


def written(rows: DataFrame) -> DataFrame:
    """A table written to the checkpoint folder and read back, for loops: unlike a checkpoint it does not hand on the constraints that the
    optimizer found, which double in each round that renames a column."""
    at = f"{checkpoints(rows.sparkSession).sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    rows.write.parquet(at)
    return rows.sparkSession.read.schema(rows.schema).parquet(at)
