"""Whole-frame projections, unions and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

INDEX_COLUMN_NAMES = ("_c0", "index", "")


def prefix_columns(prefix: str, df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def is_index_column(name: str) -> bool:
    """Columns a spreadsheet-style writer leaves behind; recognised by name, never by position."""
    return name in INDEX_COLUMN_NAMES or name.startswith("Unnamed")


def drop_index_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if is_index_column(c)])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union aligned by name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named frame with its row count, as a single job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass through while the job's own write runs; no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_null_rows(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=list(fields) if fields else None)
