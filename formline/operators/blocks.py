"""Splitting of oversized groups into ordered blocks.

A window over a group runs in one task, so a group that holds a large share of
all rows would be one task's work. ``with_blocks`` cuts such groups, and only
those, into blocks that follow the group's order; a window over (group, block)
is then bounded, and the caller carries what crosses a block's edge.

Cuts depend only on values (counts and a hash of the ordering columns), never
on partition ids, so a recomputed task puts every row in the same block. The
sample places the cuts; no row is left out of the result because of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = "_block"
TIE = "_tie"
TIE_BUCKETS = 64
COPIES_AT_ONCE = 100_000
#: Above every number of a tied row: the cut behind a tied value.
BEHIND = (1 << 63) - 1
MAX_GROUP_ROWS_CONF = "spark.formline.maxGroupRows"
DEFAULT_MAX_GROUP_ROWS = 1_000_000
MAX_BLOCKS_PER_GROUP = 65_536
SAMPLED_ROWS_PER_BLOCK = 8
CUTS_PER_LIST = 256
# Cut points worth sending to every executor: about 40 bytes each.
BROADCAST_CUTS = 500_000


def max_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_GROUP_ROWS_CONF, str(DEFAULT_MAX_GROUP_ROWS)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys meet; the right side's copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def oversized_groups(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Groups above the limit with their row count; reads only the keys and counts map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)


def _blocks_wanted(limit: int) -> Column:
    return F.least(F.ceil(F.col("_rows") / limit), F.lit(MAX_BLOCKS_PER_GROUP)).cast("int")


def _numbered_ties(df: DataFrame, tied: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_tie``: a number from 0 for each row of a tied order value, -1 for all other rows.

    Equal rows collapse map-side into one with a count, so a value that holds much of the data is never
    gathered. The rows left of a value are dealt to buckets by a hash of their other columns; a bucket's
    numbers start after those of the buckets before it, and the copies of a row take consecutive numbers.
    """
    value = [*keys, *order]
    rest = [c for c in df.columns if c not in value]
    marked = null_safe_join(df, tied.select(*value, F.lit(True).alias("_tied")), value, "left")
    plain = marked.where("_tied is null").drop("_tied").withColumn(TIE, F.lit(-1).cast("bigint"))
    folded = marked.where("_tied").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    folded = folded.withColumn("_bucket", F.pmod(F.xxhash64(*(rest or value)), F.lit(TIE_BUCKETS)))
    before = W.partitionBy(*value).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = folded.groupBy(*value, "_bucket").agg(F.sum("_copies").alias("_total"))
    totals = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    inside = W.partitionBy(*value, "_bucket").orderBy(*(rest or value)).rowsBetween(W.unboundedPreceding, -1)
    start = F.col("_offset") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    placed = null_safe_join(folded, totals, [*value, "_bucket"]).withColumn("_start", start)
    # The copies are laid out in two steps, so that no array holds all numbers of a value and no task writes all its rows.
    steps = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / COPIES_AT_ONCE))
    parts = placed.withColumn("_step", F.explode(steps)).repartition(*value, "_start", "_step")
    low = F.col("_step") * COPIES_AT_ONCE
    numbers = F.sequence(low, F.least(low + COPIES_AT_ONCE, F.col("_copies")) - 1)
    return plain.unionByName(parts.select(*df.columns, F.explode(numbers).alias("_n"), "_start").select(
        *df.columns, (F.col("_start") + F.col("_n")).alias(TIE)
    ))


def _tie_cuts(tied: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """Per group the cuts inside tied values: every ``limit`` rows, and one behind the value."""
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(limit).cast("bigint"))
    cuts = F.transform(F.concat(numbers, F.array(F.lit(BEHIND))), lambda n: F.struct(*order, n.alias(TIE)))
    return tied.select(*keys, cuts.alias("_own")).groupBy(*keys).agg(F.flatten(F.collect_list("_own")).alias("_own"))


def _cut_lists(
    df: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int, tied: DataFrame | None = None
) -> DataFrame:
    """Per oversized group its cut points, in ascending lists of at most ``CUTS_PER_LIST``."""
    step = F.greatest(F.lit(1), F.floor(F.col("_rows") / (F.col("_wanted") * SAMPLED_ROWS_PER_BLOCK)))
    sampled = null_safe_join(df.select(*dict.fromkeys([*keys, *order])), hot, keys).where(
        F.pmod(F.xxhash64(*order), step) == 0
    )
    samples = sampled.groupBy(*keys).agg(
        F.sort_array(F.collect_set(F.struct(*order))).alias("_sample"), F.max("_wanted").alias("_wanted")
    )
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("_wanted") - 1),
        lambda i: F.get("_sample", F.floor(i.cast("long") * F.size("_sample") / F.col("_wanted")).cast("int")),
    )
    if tied is None:
        cut = samples.withColumn("_cuts", cuts)
    else:
        samples = samples.withColumn("_cuts", F.transform(cuts, lambda c: F.struct(*[c[o].alias(o) for o in order], F.lit(-1).cast("bigint").alias(TIE))))
        own = _tie_cuts(tied, keys, order, limit)
        names = own.withColumnsRenamed({k: f"_own_{k}" for k in keys})
        both = samples.join(names, [F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in keys], "full")
        empty = F.array().cast(own.schema["_own"].dataType)
        cut = both.select(
            *[F.coalesce(k, f"_own_{k}").alias(k) for k in keys],
            F.array_sort(F.concat(F.coalesce("_cuts", empty), F.coalesce("_own", empty))).alias("_cuts"),
        )
    lists = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / CUTS_PER_LIST).cast("int")),
        lambda i: F.slice("_cuts", i * CUTS_PER_LIST + 1, F.lit(CUTS_PER_LIST)),
    )
    return (
        cut.where(F.size("_cuts") > 0).withColumn("_lists", lists).select(*keys, "_lists")
    )


def _block_of(position: Column) -> Column:
    """Number of cut points at or below the position: first over the lists, then inside one."""
    whole = F.size(F.filter("_lists", lambda cuts: cuts[0] <= position))
    inside = F.size(F.filter(F.get("_lists", whole - 1), lambda cut: cut <= position))
    return F.when(F.col("_lists").isNull() | (whole == 0), 0).otherwise((whole - 1) * CUTS_PER_LIST + inside)


def with_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int | None = None
) -> tuple[DataFrame, bool]:
    """Add ``_block``: 0 in ordinary groups, rising along ``order`` in oversized ones.

    Rows equal in ``order`` share a block unless there are more of them than the limit: those are numbered
    and cut by their numbers, so no block of theirs holds more than the limit. Returns the frame and whether
    any group was cut. Group sizes are measured with one aggregation over the key columns.
    """
    limit = limit or max_group_rows(df.sparkSession)
    hot = oversized_groups(df, keys, limit).withColumn("_wanted", _blocks_wanted(limit))
    size = hot.agg(F.coalesce(F.sum("_wanted"), F.lit(0)).alias("cuts")).first()
    if not size.cuts:
        return df.withColumn(BLOCK, F.lit(0)), False
    small = size.cuts <= BROADCAST_CUTS
    hot = F.broadcast(hot) if small else hot
    value = [*keys, *order]
    # At most one tied value per ``limit`` rows of the oversized groups.
    tied = null_safe_join(df.select(*dict.fromkeys(value)), hot.select(*keys), keys).groupBy(*dict.fromkeys(value)).agg(
        F.count(F.lit(1)).alias("_copies")
    ).where(F.col("_copies") > limit)
    if tied.isEmpty():
        lists = _cut_lists(df, hot, keys, order, limit)
        position = F.struct(*order)
    else:
        lists = _cut_lists(df, hot, keys, order, limit, tied)
        df = _numbered_ties(df, F.broadcast(tied) if small else tied, keys, order)
        position = F.struct(*order, TIE)
    placed = null_safe_join(df, F.broadcast(lists) if small else lists, keys, "left")
    return placed.withColumn(BLOCK, _block_of(position)).drop("_lists", TIE), True
