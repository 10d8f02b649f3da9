"""Small helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.scratch import new_folder

#: Ids up to this many are sent to every executor; more are joined by shuffle. 16 MB at 8 bytes each.
BROADCAST_IDS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def stored(rows: DataFrame, label: str, among: list[str] | None = None) -> DataFrame:
    """The rows, written once to the folder all executors share and read back.

    What follows starts from files: it isn't computed twice, and a lost executor costs a re-read.
    ``among`` collects the folders of tables that can be discarded once a later one is stored.
    """
    path = new_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    if among is not None:
        among.append(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Remove stored tables that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, columns: list[str]) -> str:
    """A column name like the given one that no column has; Spark's names differ by more than case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(id_column: str, parts: int, part: int) -> Column:
    """Whether a row belongs to the held-out fold; a row without an id does not."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(parts)) == part, F.lit(False))


def only(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows whose id is among ``ids``; few ids go to the rows, many meet them in a shuffle."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, column, "left_semi")
