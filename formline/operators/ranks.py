"""Ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formline.operators.blocks import BLOCK, max_group_rows, null_safe_join, oversized_groups, with_blocks
from formline.scratch import kept


def _ordering(value: str, ascending: bool) -> Column:
    return F.asc_nulls_last(value) if ascending else F.desc_nulls_last(value)


def rank_within(
    df: DataFrame, keys: Sequence[str], value: str, out: str, ascending: bool = False, limit: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """SQL ``rank()`` of ``value`` inside ``keys``, NULLs last.

    Ordinary groups use one window. Once a group exceeds the limit, ranks come from counts
    of distinct values instead (see ``rank_by_counts``), which no task holds whole.

    The sizes of the groups are measured first. ``derived`` says that ``df`` is costly to compute: it is then stored
    once, and the sizes are read from its key columns alone.
    """
    limit = limit or max_group_rows(df.sparkSession)
    df = kept(df, "ranked") if derived else df
    if oversized_groups(df, keys, limit).isEmpty():
        return df.withColumn(out, F.rank().over(W.partitionBy(*keys).orderBy(_ordering(value, ascending))))
    return rank_by_counts(df, keys, value, out, ascending, limit)


def rank_by_counts(
    df: DataFrame, keys: Sequence[str], value: str, out: str, ascending: bool = False, limit: int | None = None
) -> DataFrame:
    """Rank as one plus the rows with a better value.

    Copies of a value collapse map-side, the distinct values are cut into blocks, and a
    block's rows start after the total of the better blocks (a table of block totals).
    """
    order = _ordering(value, ascending)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_copies"))
    # NULL sorts below every value in a cut, so an ascending rank puts it last by its own column.
    counts = counts.withColumn("_missing", F.col(value).isNull())
    blocks, _ = with_blocks(counts, keys, ["_missing", value] if ascending else [value], limit)
    block_order = F.asc(BLOCK) if ascending else F.desc(BLOCK)

    inside = W.partitionBy(*keys, BLOCK).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy(*keys).orderBy(block_order).rowsBetween(W.unboundedPreceding, -1)
    totals = (
        blocks.groupBy(*keys, BLOCK)
        .agg(F.sum("_copies").alias("_total"))
        .withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .drop("_total")
    )
    ranked = null_safe_join(
        blocks.withColumn("_better", F.coalesce(F.sum("_copies").over(inside), F.lit(0))), totals, [*keys, BLOCK]
    ).select(*keys, value, (F.col("_offset") + F.col("_better") + 1).cast("int").alias(out))
    return null_safe_join(df, ranked, [*keys, value])


def ranks_by_window(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A ``rank_<measure>`` column per measure, descending; one shuffle, one sort per measure."""
    window = W.partitionBy(*keys)
    return df.withColumns(
        {f"rank_{m}": F.rank().over(window.orderBy(F.desc_nulls_last(m))) for m in measures}
    )


def stack_metrics(df: DataFrame, ids: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Wide to long: one row per id and measure, NULL values kept."""
    return df.unpivot(list(ids), list(measures), "metric", "metric_value")


def ranks_by_stacking(
    df: DataFrame, keys: Sequence[str], ids: Sequence[str], measures: Sequence[str], limit: int | None = None
) -> DataFrame:
    """Same columns as ``ranks_by_window`` for groups too large for one task.

    All measures are ranked in long form with counts of distinct values, then laid out
    again as columns. ``ids`` with ``keys`` identify a row.
    """
    long = stack_metrics(df.select(*keys, *ids, *[F.col(m).cast("double") for m in measures]), [*keys, *ids], measures)
    ranked = rank_by_counts(long, [*keys, "metric"], "metric_value", "_rank", limit=limit)
    wide = ranked.groupBy(*keys, *ids).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("_rank"))).alias(f"rank_{m}") for m in measures]
    )
    return null_safe_join(df, wide, [*keys, *ids])
