"""What the corpus operators share: tables read once, lineage cuts, held-out folds, row carrying."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Frees the shuffle files of a statement when it ends: every statement below ends in a written table.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows with whole texts or sets of shingles that go to Python at a time.
TEXT_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it; a temporary one only where none is named (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = f"file://{os.path.join(tempfile.gettempdir(), 'frameloom-checkpoints')}"
    return where.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, what: str, batch_rows: int | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends here, and lost executors cost no recomputation.

    batch_rows: how many rows at a time go to Python, where rows may be large.
    """
    spark = df.sparkSession
    path, schema = new_path(spark, what), df.schema
    settings = {_CLEANUP: "true"} | ({} if batch_rows is None else {_BATCH: str(batch_rows)})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    written = spark.read.schema(schema).parquet(path)
    written._written_to = path
    return written


def forget(*written: DataFrame) -> None:
    """Delete tables of write_table that nothing still to be run reads."""
    for df in written:
        where = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
        where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def make_path(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, for mapInArrow or mapInPandas. When a task is through, its worker, which stays for later tasks, gives back the memory that Arrow and the C library hold unused."""

    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
            trim(0)

    return tidied


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id's decimal text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def text_of(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def carried(df: DataFrame, **columns: Column) -> DataFrame:
    """The named columns beside the caller's own, which go under numbered names and so clash with nothing and can be pruned."""
    return df.select(*(c.alias(n) for n, c in columns.items()), *(df[f"`{c}`"].alias(f"__c{i}") for i, c in enumerate(df.columns)))


def restored(df: DataFrame, names: list[str], *added: str) -> DataFrame:
    """The caller's columns again, then the added ones; an added column replaces one of the caller's of that name."""
    return df.select(*(F.col(f"__c{i}").alias(n) for i, n in enumerate(names) if n not in added), *added)
