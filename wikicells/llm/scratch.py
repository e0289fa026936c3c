"""Cuts of lineage: intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a folder of its own only for a local master without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="wikicells-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads them back.

    The table outlives the loss of any executor. It stays until the cluster clears the folder, as a
    lazy result may still read it. `batch_rows` bounds the rows that go to Python at a time, for rows
    of whole texts.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path, before = f"{shared_folder(spark)}/wikicells-{uuid.uuid4().hex}", spark.conf.get(key)
    try:
        if batch_rows:
            spark.conf.set(key, batch_rows)
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Gives the driver's memory of finished plans and results back, as a stage of many jobs leaves much of it.

    Handles that Python still holds go first, so that the JVM can drop what they stand for; a full
    collection then returns the emptied part of the heap to the system.
    """
    gc.collect()
    spark._jvm.java.lang.System.gc()
