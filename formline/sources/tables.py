"""Parquet in, and all outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from formline.operators.columns import drop_index_columns
from formline.schemas import TABLES
from formline.scratch import compressed
from formline.sources.csv import REST, scan_csv_prefix

#: Rows of a compressed CSV file.
ROWS_PER_FILE = 200_000


def scan_parquet(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def _check_layout(spark: SparkSession, path: str, partition_by: Sequence[str]) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    found = {n.split("=")[0] if "=" in n else "" for n in names if not n.startswith(("_", "."))}
    if found - {partition_by[0] if partition_by else ""}:
        wanted = f"partitioned by {', '.join(partition_by)}" if partition_by else "without partitions"
        raise ValueError(f"{path} holds a table of another layout; rows {wanted} can't be added to it")


def sink_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write Parquet. With partition columns, ``overwrite`` replaces only the partitions written,
    so a day can be run again without doubling or dropping rows. Adding to a folder of another
    layout is an error: readers would not see part of its rows.

    Rows of one partition value are spread over tasks by Spark's rebalancing, which also splits a
    value that holds much of the data.
    """
    if partition_by or mode == "append":
        _check_layout(df.sparkSession, path, partition_by)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def period_name(begin: str, end: str | None = None) -> str:
    return "_".join(d.replace("-", "") for d in (begin, end) if d)


def sink_csv_period(
    df: DataFrame, folder: str, table: str, begin: str, end: str | None = None, compression: str = "none"
) -> str:
    """Write one period's rows as ``<folder>/<table>/<table>_<begin>[_<end>]``, dates without dashes.

    The name is the period's, so writing it again replaces it, and ``scan_csv_prefix`` on
    ``<folder>/<table>`` reads all periods. ``compression`` is ``none`` or ``gzip``; compressed files are small, as
    a reader can't split them.
    """
    path = f"{folder.rstrip('/')}/{table}/{table}_{period_name(begin, end)}"
    if compression not in ("none", "gzip"):
        raise ValueError(f"compression must be none or gzip, not {compression}")
    writer = df.write if compression == "none" else compressed(df, ROWS_PER_FILE)
    writer.mode("overwrite").option("header", True).csv(path)
    return path


def sink_warehouse_table(
    df: DataFrame, database: str, table: str, mode: str = "overwrite", bucket_by: Sequence[str] = (), buckets: int | None = None,
    path: str | None = None,
) -> str:
    """Save as a table of the catalog, below ``path`` where one is given; returns its name.

    With ``bucket_by`` the rows lie in one sorted file per bucket (as many as a shuffle has partitions, unless told
    otherwise), so joins and groupings on these columns read them without an exchange.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = (df.repartition(buckets, *bucket_by) if bucket_by else df).write.mode(mode).format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def season_column(df: DataFrame) -> str:
    """The season's column as the table spells it."""
    return next(c for c in df.columns if c.lower() == "season")


def snapshot_tables(spark: SparkSession, source: str, target: str, tables: Sequence[str] | None = None) -> list[str]:
    """CSV folders to Parquet by season, with declared types and every undeclared statistic in ``stats_extra``.

    Stray index columns are dropped by name. A run replaces the seasons it has rows of and leaves the others.
    """
    done = []
    for table in tables or [t for t in TABLES if t != "scheduled"]:
        rows = drop_index_columns(scan_csv_prefix(spark, f"{source.rstrip('/')}/{table}", TABLES[table], REST.get(table)))
        path = f"{target.rstrip('/')}/{table}"
        sink_parquet(rows, path, partition_by=[season_column(rows)])
        done.append(path)
    return done
