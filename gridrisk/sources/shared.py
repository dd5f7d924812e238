"""The folder that driver and executors share, and frames pinned to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session without it (tests) gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        found = tempfile.mkdtemp(prefix="spark-shared-")
    return found


def pinned(df: DataFrame) -> DataFrame:
    """df by a reliable checkpoint: what two branches of a plan must agree on isn't computed twice, and lost executors don't change it."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()
