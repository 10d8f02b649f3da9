"""Working folders for data a job writes and reads back.

Executors on other machines must see these folders, so they live below the
shared folder named by ``spark.checkpoint.dir``. Only where that setting is
missing and Spark runs in one process (tests, a laptop) is a folder of this machine used.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Documents in a compressed file. A reader can't split one, so files stay small, whatever a task writes.
DOCUMENTS_PER_FILE = 20_000


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="formline-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/formline/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read from there, for input that is read several times."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder of ``new_folder`` that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def compressed(df: DataFrame, rows_per_file: int = DOCUMENTS_PER_FILE) -> DataFrameWriter:
    """A writer of compressed text or JSON, in files small enough to be shared out among the readers.

    The fastest level: it takes a fraction of the time, and lines that are much alike still come to a small part of their text.
    """
    return df.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", rows_per_file)


@contextmanager
def open_writers(spark: SparkSession, values: int) -> Iterator[None]:
    """Within, writes by partition keep a file open per value, for as many values; without it Spark sorts a task's rows first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(values))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
