"""Tables between steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; on a local master without one, a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = f"file://{tempfile.gettempdir()}/frameloom-tables"
    return where.rstrip("/")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, what: str, batch_rows: int | None = None) -> DataFrame:
    """df as a table of the shared folder: its lineage ends here, and a lost executor costs no step before it.

    batch_rows: how many rows at a time go to Python, where rows may be large.
    """
    path = f"{shared_folder(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    before = df.sparkSession.conf.get(_BATCH, None)
    if batch_rows is not None:
        df.sparkSession.conf.set(_BATCH, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        if batch_rows is not None:
            df.sparkSession.conf.unset(_BATCH) if before is None else df.sparkSession.conf.set(_BATCH, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str) -> None:
    where, store = _path(spark, path)
    store.delete(where, True)
