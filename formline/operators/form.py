"""Recent form: averages over the last N games, as they stood before a given date.

``FormSpec`` describes whose form is meant (teams, pitchers, anything with games), so one
implementation serves all of them.

Order inside a group is (date, id, measures) descending: newest first, ties on a date by the
later id, and rows that still tie have equal measures, so no result depends on task order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formline.functions import scalars
from formline.operators.blocks import BLOCK, max_group_rows, null_safe_join, oversized_groups, with_blocks
from formline.operators.ranks import ranks_by_stacking, ranks_by_window
from formline.scratch import kept

AS_OF = "as_of"
# Averages of ratios are rounded here so that equal averages tie however they were summed.
RATIO_DIGITS = 12
# Distinct (season, date) pairs that may be sent to every executor, a few bytes each.
BROADCAST_DATES = 2_000_000
#: Rows of an entity and season that are sorted with those of others, whatever the number on one date.
SHORT_SEASON = 10_000
#: Ranks of values by day that may be sent to every executor, four bytes each.
BROADCAST_RANKS = 8_000_000


@dataclass(frozen=True)
class FormSpec:
    entity: tuple[str, ...]
    measures: tuple[str, ...]
    windows: tuple[int, ...]
    ratios: frozenset[str] = frozenset()
    carry: tuple[str, ...] = ()
    season: str = "season"
    date: str = "officialdate"
    id: str = "id"

    @property
    def keys(self) -> list[str]:
        return [*self.entity, self.season]

    @property
    def source_columns(self) -> list[str]:
        return list(dict.fromkeys([*self.keys, self.date, self.id, *self.carry, *self.measures]))

    @property
    def form_columns(self) -> list[str]:
        return [f"{m}_last_{n}" for n in self.windows for m in self.measures]

    @property
    def rank_columns(self) -> list[str]:
        return [f"rank_{c}" for c in self.form_columns]

    @property
    def depth(self) -> int:
        return max(self.windows)

    def within_date(self) -> list[Column]:
        return [F.desc_nulls_last(c) for c in (self.id, *self.measures, *self.carry)]

    def newest_first(self) -> list[Column]:
        return [F.desc_nulls_last(self.date), *self.within_date()]


TEAM_FORM = FormSpec(
    entity=("team_name",),
    measures=("runs", "batting_avg", "strikeouts", "walks"),
    windows=(1, 3, 7, 15),
    ratios=frozenset({"batting_avg"}),
)
PITCHER_FORM = FormSpec(
    entity=("player_name",), measures=("strikeouts", "runs"), windows=(1, 3, 7), carry=("team_name",)
)
# Two players may share a name; where ids are known they are the better key.
PITCHER_FORM_BY_ID = FormSpec(
    entity=("player_id",), measures=("strikeouts", "runs"), windows=(1, 3, 7), carry=("team_name", "player_name")
)


def team_measures(batting: DataFrame) -> DataFrame:
    """Team batting rows with batting average and walks; copies of a record count once.

    Columns are chosen before the distinct, so only what form needs is shuffled.
    """
    return (
        batting.withColumns({
            "batting_avg": scalars.batting_average("hits", "atbats"),
            "walks": scalars.walks_total("baseonballs", "intentionalwalks"),
        })
        .select("team_name", "season", "officialdate", "id", "runs", "batting_avg", "strikeouts", "walks")
        .distinct()
    )


def pitcher_measures(pitching: DataFrame, completed_only: bool = True) -> DataFrame:
    """Pitching rows of finished games (or of all games) with a date-typed date."""
    rows = pitching.where("detailedstate = 'Final'") if completed_only else pitching
    return rows.withColumn("officialdate", F.to_date("officialdate"))


def _trailing(spec: FormSpec, partition: Sequence[str], order: Sequence[Column], counts: bool = False) -> dict[str, Column]:
    newest = W.partitionBy(*partition).orderBy(*order)
    out = {}
    for n in spec.windows:
        # Newest first, so the rows that follow are the older games.
        frame = newest.rowsBetween(0, n - 1)
        for m in spec.measures:
            average = F.avg(m).over(frame)
            out[f"{m}_last_{n}"] = F.round(average, RATIO_DIGITS) if m in spec.ratios else average
        if counts:
            out[f"games_last_{n}"] = F.count(F.lit(1)).over(frame)
    return out


def trailing_rows(
    df: DataFrame, spec: FormSpec, counts: bool = False, limit: int | None = None, derived: bool = False
) -> DataFrame:
    """Every row with its averages over itself and the N-1 older rows of its entity and season.

    Groups above the size limit run block by block; each block also reads the last N-1 rows
    that precede it (see ``_with_older_rows``), which are dropped from the output. Group sizes are
    measured first; input that is costly to compute (``derived``) is stored once for both passes.
    """
    df = kept(df, "trailing") if derived else df
    order = [spec.date, spec.id, *spec.measures]
    blocks, cut = with_blocks(df, spec.keys, order, limit)
    if not cut:
        return df.withColumns(_trailing(spec, spec.keys, spec.newest_first(), counts))
    padded = _with_older_rows(blocks, spec)
    trailed = padded.withColumns(_trailing(spec, [*spec.keys, BLOCK], spec.newest_first(), counts))
    return trailed.where(~F.col("_older")).drop(BLOCK, "_older")


def _with_older_rows(blocks: DataFrame, spec: FormSpec) -> DataFrame:
    """Blocks plus, under the same block number, the last N-1 rows from before the block.

    The tails of all blocks of a group are a small table; in its order, the rows just before a
    block's first tail row are exactly the newest rows of the earlier blocks.
    """
    need = spec.depth - 1
    plain = blocks.withColumn("_older", F.lit(False))
    if need == 0:
        return plain
    inside = W.partitionBy(*spec.keys, BLOCK).orderBy(*spec.newest_first())
    tails = blocks.withColumn("_nth", F.row_number().over(inside)).where(F.col("_nth") <= need)
    rows = [c for c in blocks.columns if c != BLOCK]
    along = W.partitionBy(*spec.keys).orderBy(F.asc(BLOCK), F.desc("_nth"))
    earlier = (
        tails.withColumns({
            "_before": F.collect_list(F.struct(*rows)).over(along.rowsBetween(-need, -1)),
            "_first": F.coalesce(F.lag(BLOCK).over(along) < F.col(BLOCK), F.lit(False)),
        })
        .where("_first")
        .select(BLOCK, F.explode("_before").alias("_row"))
        .select(*[F.col(f"_row.{c}").alias(c) for c in rows], BLOCK, F.lit(True).alias("_older"))
    )
    return plain.unionByName(earlier)


def seasons_are_short(df: DataFrame, spec: FormSpec) -> bool:
    """Whether no entity has more than ``SHORT_SEASON`` rows in a season; reads only the keys."""
    return oversized_groups(df, spec.keys, min(SHORT_SEASON, max_group_rows(df.sparkSession))).isEmpty()


def snapshots(df: DataFrame, spec: FormSpec, counts: bool = False, short: bool = False) -> DataFrame:
    """Form after each date played: one row per entity, season and date.

    No average reaches deeper than N rows into a date, so only the newest N rows of each
    date are kept, and Spark applies that limit map-side before the shuffle. What the
    trailing window then sees is bounded by days of a season times N, however many rows
    one entity or one date has. Where ``seasons_are_short`` that limit saves nothing: with
    ``short`` one shuffle and one sort bring all rows of an entity together.
    """
    if short:
        newest = W.partitionBy(*spec.keys).orderBy(*spec.newest_first())
        newer = F.lag(F.struct(spec.date)).over(newest)
        trailed = df.select(*spec.source_columns).withColumns({
            **_trailing(spec, spec.keys, spec.newest_first(), counts), "_tops": ~newer.eqNullSafe(F.struct(spec.date)),
        })
        return trailed.where("_tops").drop("_tops", *[m for m in spec.measures if m not in spec.carry])
    on_date = W.partitionBy(*spec.keys, spec.date).orderBy(*spec.within_date())
    newest = (
        df.select(*spec.source_columns)
        .withColumn("_nth", F.row_number().over(on_date))
        .where(F.col("_nth") <= spec.depth)
    )
    order = [F.desc_nulls_last(spec.date), F.asc("_nth")]
    return (
        newest.withColumns(_trailing(spec, spec.keys, order, counts))
        .where(F.col("_nth") == 1)
        .drop("_nth", *[m for m in spec.measures if m not in spec.carry])
    )


def last_before(wanted: DataFrame, snaps: DataFrame, spec: FormSpec) -> DataFrame:
    """Strict as-of lookup: for each wanted (entity, season, as_of) the newest snapshot before it.

    Both sides become one ordered sequence per entity and season, in which a wanted date
    stands ahead of a snapshot of the same day; the last snapshot seen is the answer. Both
    sides hold at most one row per day, so groups stay small and no pairs are formed.
    """
    values = [c for c in snaps.columns if c not in spec.keys]
    asks = wanted.select(*spec.keys, AS_OF).distinct()
    events = snaps.select(
        *spec.keys, F.col(spec.date).alias(AS_OF), F.lit(1).alias("_kind"), F.struct(*values).alias("_form")
    ).unionByName(asks.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    seen = W.partitionBy(*spec.keys).orderBy(AS_OF, "_kind").rowsBetween(W.unboundedPreceding, 0)
    return (
        events.withColumn("_form", F.last("_form", ignorenulls=True).over(seen))
        .where((F.col("_kind") == 0) & F.col("_form").isNotNull())
        .select(*spec.keys, AS_OF, "_form.*")
    )


def form_before(wanted: DataFrame, df: DataFrame, spec: FormSpec) -> DataFrame:
    """What ``last_before`` finds among the snapshots of these rows, for all (entity, season, as_of) wanted.

    Where ``seasons_are_short``, rows and wanted dates stand in one sequence per entity and season, a wanted date
    ahead of the rows of its day: its form is that of the N rows before it. That is one shuffle and one sort of the
    rows, which need no form of their own. Otherwise snapshots are made and looked up.
    """
    numbers = (T.IntegralType, T.FloatType, T.DoubleType)
    plain = all(isinstance(df.schema[m].dataType, numbers) for m in spec.measures)
    if not plain or not seasons_are_short(df, spec):
        return last_before(wanted, snapshots(df, spec), spec)
    values = [c for c in spec.source_columns if c not in spec.keys]
    events = df.select(
        *spec.keys, F.col(spec.date).alias(AS_OF), F.lit(1).alias("_kind"), F.struct(*values).alias("_row")
    ).unionByName(wanted.select(*spec.keys, AS_OF).distinct().withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    oldest = [F.asc_nulls_first(f"_row.{c}") for c in (spec.id, *spec.measures, *spec.carry)]
    seen = W.partitionBy(*spec.keys).orderBy(AS_OF, "_kind", *oldest)
    # The rows before a wanted date, newest first; other wanted dates among them are passed over.
    events = events.withColumns({f"_{i}": F.expr(f"lag(_row, {i}) ignore nulls").over(seen) for i in range(1, spec.depth + 1)})
    found = events.where("_kind = 0 and _1 is not null")

    def average(measure: str, n: int) -> Column:
        rows = [F.col(f"_{i}.{measure}").cast("double") for i in range(1, n + 1)]
        total, known = F.lit(0.0), F.lit(0)
        for value in rows:
            total, known = total + F.coalesce(value, F.lit(0.0)), known + value.isNotNull().cast("int")
        out = F.try_divide(total, known)
        return F.round(out, RATIO_DIGITS) if measure in spec.ratios else out

    return found.select(
        *spec.keys, AS_OF, *[F.col(f"_1.{c}").alias(c) for c in values if c not in spec.measures or c in spec.carry],
        *[average(m, n).alias(f"{m}_last_{n}") for n in spec.windows for m in spec.measures],
    )


def with_ties(found: DataFrame, rows: DataFrame, spec: FormSpec) -> DataFrame:
    """Replace each as-of answer by all rows of its date (a doubleheader gives two).

    ``rows`` come from ``trailing_rows``; the join is on entity, season and date.
    """
    dates = found.select(*spec.keys, AS_OF, spec.date)
    return rows.drop(*[m for m in spec.measures if m not in spec.carry]).join(dates, [*spec.keys, spec.date])


def _dates(as_of: DataFrame, spec: FormSpec) -> DataFrame:
    return as_of.where(F.col(AS_OF).isNotNull()).select(spec.season, F.col(AS_OF).cast("date").alias(AS_OF)).distinct()


def _day_lists(dates: DataFrame, spec: FormSpec) -> DataFrame:
    return dates.groupBy(spec.season).agg(F.sort_array(F.collect_set(AS_OF)).alias("_days"))


def _spans(snaps: DataFrame, as_of: DataFrame, spec: FormSpec, days: int | None = None) -> DataFrame:
    """Snapshots with their season's sorted as-of dates (``_days``) and the slice of them they count on.

    ``as_of`` has (season, as_of) rows. A season's dates form one sorted list, and a second list,
    limited by the calendar, says for every day of the season how many dates there are up to it.
    A snapshot counts on the dates from the day after it up to the day of the next one: two
    lookups give the start (``_past``) and length (``_span``) of that slice. ``days`` is an
    upper bound of the (season, as_of) rows where the caller has one; otherwise they are
    counted, and broadcast only if few.
    """
    dates = _dates(as_of, spec)
    small = (dates.count() if days is None else days) <= BROADCAST_DATES
    lists = _day_lists(dates, spec)
    gap = lambda d, i: F.coalesce(F.date_diff(F.get("_days", i + 1), d), F.lit(1))
    upto = F.flatten(F.transform("_days", lambda d, i: F.array_repeat(i + 1, gap(d, i))))
    lists = lists.withColumn("_upto", upto)

    def dates_upto(day):
        place = F.date_diff(day, F.get("_days", F.lit(0)))
        return F.when(place < 0, 0).when(place >= F.size("_upto"), F.size("_days")).otherwise(F.get("_upto", place))

    following = F.lead(spec.date).over(W.partitionBy(*spec.keys).orderBy(spec.date))
    valid = snaps.withColumn("_until", following).join(F.broadcast(lists) if small else lists, spec.season)
    # Spans are numbers before the explode: a snapshot without a date, or without a day to count on, has none.
    valid = valid.withColumn("_past", dates_upto(F.col(spec.date)))
    valid = valid.withColumn("_span", F.coalesce(dates_upto(F.col("_until")), F.size("_days")) - F.col("_past"))
    return valid.drop("_until", "_upto")


def as_of_grid(snaps: DataFrame, as_of: DataFrame, spec: FormSpec, days: int | None = None) -> DataFrame:
    """Form of every entity on every as-of date of its season, for ranking; ``as_of`` and ``days`` as in ``_spans``.

    The work is that of the rows put out.
    """
    valid = _spans(snaps, as_of, spec, days)
    days_valid = F.slice("_days", F.col("_past") + 1, F.greatest("_span", F.lit(0)))
    return valid.withColumn(AS_OF, F.explode(days_valid)).drop("_days", "_past", "_span")


def values_ranked(snaps: DataFrame, as_of: DataFrame, spec: FormSpec, days: int | None = None) -> DataFrame:
    """``(season, as_of, metric, value, rank)``: the rank of each form value that some entity has on a date.

    A snapshot adds one to its values on the first date it counts on and takes it off behind the last. Changes
    of equal values collapse map-side, and running totals over the dates give how many entities have a value on
    each, so no row is made per entity and date.
    """
    ranked = _ranked_places(_held(_spans(snaps, as_of, spec, days), spec).where("_copies > 0"), spec)
    places = _day_lists(_dates(as_of, spec), spec).select(spec.season, F.posexplode("_days").alias("_place", AS_OF))
    return ranked.join(places, [spec.season, "_place"]).select(spec.season, AS_OF, "metric", "value", "rank")


def _held(spans: DataFrame, spec: FormSpec) -> DataFrame:
    """How many entities have a value (``_copies``) from one place among the dates (``_at``) to the next change (``_next``)."""
    values = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in spec.form_columns])
    edges = F.array(
        F.struct(F.col("_past").alias("_at"), F.lit(1).alias("_change")),
        F.struct((F.col("_past") + F.col("_span")).alias("_at"), F.lit(-1).alias("_change")),
    )
    changes = spans.where("_span > 0").select(spec.season, F.explode(edges).alias("_edge"), values.alias("_values")).select(
        spec.season, "_edge.*", F.inline("_values")
    )
    value = [spec.season, "metric", "value"]
    changes = changes.groupBy(*value, "_at").agg(F.sum("_change").alias("_change"))
    along = W.partitionBy(*value).orderBy("_at")
    return changes.withColumns({
        "_copies": F.sum("_change").over(along.rowsBetween(W.unboundedPreceding, 0)), "_next": F.lead("_at").over(along),
    })


def _ranked_places(held: DataFrame, spec: FormSpec) -> DataFrame:
    better = W.partitionBy(spec.season, "_place", "metric").orderBy(F.desc_nulls_last("value")).rowsBetween(W.unboundedPreceding, -1)
    return held.withColumn("_place", F.explode(F.sequence("_at", F.col("_next") - 1))).withColumn(
        "rank", (F.coalesce(F.sum("_copies").over(better), F.lit(0)) + 1).cast("int")
    )


def _few_ranks(snaps: DataFrame, dates: DataFrame, spec: FormSpec) -> bool:
    """Whether the values of all metrics, counted approximately, on all dates of their season fit a broadcast."""
    distinct = [F.approx_count_distinct(c) + 1 for c in spec.form_columns]
    values = snaps.groupBy(spec.season).agg(sum(distinct[1:], distinct[0]).alias("_values"))
    ranks = values.join(dates.groupBy(spec.season).agg(F.count(F.lit(1)).alias("_n")), spec.season)
    return (ranks.agg(F.sum(F.col("_values") * F.col("_n")).alias("n")).first().n or 0) <= BROADCAST_RANKS


def day_ranks(snaps: DataFrame, as_of: DataFrame, spec: FormSpec, days: int | None = None) -> DataFrame:
    """``(season, metric, value, _first, _ranks)``: a value's ranks on the dates it is had, from place ``_first`` to the last."""
    held = _held(_spans(snaps, as_of, spec, days), spec).where("_next is not null")
    on_day = F.array_sort(F.collect_list(F.struct("_place", "rank")))
    return _ranked_places(held, spec).groupBy(spec.season, "metric", "value").agg(
        F.min("_place").alias("_first"), F.transform(on_day, lambda d: d.rank).alias("_ranks")
    )


def _with_day_ranks(rows: DataFrame, ranks: DataFrame, spec: FormSpec, found) -> DataFrame:
    """Rows with ``found(ranks, first)`` of each form value as its rank column; the ranks are broadcast, so no row moves."""
    for c, r in zip(spec.form_columns, spec.rank_columns, strict=True):
        mine = ranks.where(F.col("metric") == c).select(
            F.col(spec.season).alias("_its_season"), F.col("value").alias("_its_value"), "_first", "_ranks"
        )
        same = (rows[spec.season] == mine["_its_season"]) & rows[c].cast("double").eqNullSafe(mine["_its_value"])
        rows = rows.join(F.broadcast(mine), same).withColumn(r, found(F.col("_ranks"), F.col("_first")))
        rows = rows.drop("_its_season", "_its_value", "_first", "_ranks")
    return rows


def _ranked_grid(snaps: DataFrame, dates: DataFrame, spec: FormSpec, days: int) -> DataFrame:
    """Form and ranks of every entity on every date: the ranks of a snapshot's values on the dates it counts on, laid out."""
    ranks = kept(day_ranks(snaps, dates, spec, days), "day-ranks")
    spans = _spans(snaps, dates, spec, days).where("_span > 0")
    spans = _with_day_ranks(spans, ranks, spec, lambda ranks, first: F.slice(ranks, F.col("_past") - first + 1, F.col("_span")))
    rows = spans.select(
        *[c for c in spans.columns if c not in ("_days", "_past", "_span")],
        F.posexplode(F.slice("_days", F.col("_past") + 1, F.col("_span"))).alias("_nth", AS_OF),
    )
    return rows.withColumns({r: F.get(r, F.col("_nth")) for r in spec.rank_columns}).drop("_nth")


def ranked_wanted(
    df: DataFrame, wanted: DataFrame, as_of: DataFrame, spec: FormSpec, days: int | None = None, derived: bool = False
) -> DataFrame:
    """Rows of ``ranked_form`` for the wanted (entity, season, as_of) alone, ranked among all entities of the season.

    The ranked values of a date stand ahead of the equal ones of the rows wanted, which take the last rank seen: one
    shuffle of the rows wanted, one sort per metric. Both sides read the snapshots; of input that is costly to compute
    (``derived``) they are stored once, like the dates. Where the ranks of all values then fit a broadcast, the rows
    wanted look theirs up instead.
    """
    snaps = kept(snapshots(df, spec, short=seasons_are_short(df, spec)), "snapshots") if derived else snapshots(df, spec)
    # A snapshot without a date, or a season without one, counts on no day.
    found = last_before(wanted, snaps.where(F.col(spec.date).isNotNull() & F.col(spec.season).isNotNull()), spec)
    columns = [*spec.keys, AS_OF, spec.date, spec.id, *spec.carry, *spec.form_columns, *spec.rank_columns]
    if derived:
        as_of = kept(_dates(as_of, spec), "dates")
        days = as_of.count()
    if derived and days <= BROADCAST_DATES and _few_ranks(snaps, as_of, spec):
        places = _day_lists(as_of, spec).select(spec.season, F.posexplode("_days").alias("_place", AS_OF))
        found = found.join(F.broadcast(places), [spec.season, AS_OF])
        ranks = kept(day_ranks(snaps, as_of, spec, days), "day-ranks")
        return _with_day_ranks(found, ranks, spec, lambda ranks, first: F.get(ranks, F.col("_place") - first)).select(columns)
    found = found.withColumn("_listed", F.lit(1))
    # A listed value has its metric's column and rank alone; NULL columns of other metrics rank nothing.
    listed = values_ranked(snaps, as_of, spec, days).select(
        spec.season, AS_OF, F.lit(0).alias("_listed"),
        *[F.when(F.col("metric") == c, F.col("value")).alias(c) for c in spec.form_columns],
        *[F.when(F.col("metric") == c, F.col("rank")).alias(r) for c, r in zip(spec.form_columns, spec.rank_columns, strict=True)],
    )
    on_date = W.partitionBy(AS_OF, spec.season)
    rows = found.unionByName(listed, allowMissingColumns=True).withColumns({
        r: F.last(r, ignorenulls=True).over(on_date.orderBy(F.desc_nulls_last(c), "_listed").rowsBetween(W.unboundedPreceding, 0))
        for c, r in zip(spec.form_columns, spec.rank_columns, strict=True)
    })
    return rows.where("_listed = 1").select(columns)


def entities_fit_window(df: DataFrame, spec: FormSpec, limit: int | None = None) -> bool:
    """Whether every season's entities, counted approximately, fit one ranking task."""
    limit = limit or max_group_rows(df.sparkSession)
    counts = df.groupBy(spec.season).agg(F.approx_count_distinct(F.struct(*spec.entity)).alias("n"))
    return (counts.agg(F.max("n").alias("n")).first().n or 0) <= limit


def league_ranks(grid: DataFrame, spec: FormSpec, bounded: bool = True) -> DataFrame:
    """Rank of each form column among all entities of the season on the as-of date, descending.

    Rank 1 is the largest value, also for measures where less is better.
    """
    keys = [AS_OF, spec.season]
    if bounded:
        return ranks_by_window(grid, keys, spec.form_columns)
    return ranks_by_stacking(grid, keys, list(spec.entity), spec.form_columns)


def ranked_form(
    df: DataFrame, as_of: DataFrame, spec: FormSpec, counts: bool = False, league: int | None = None,
    days: int | None = None, many: bool = False,
) -> DataFrame:
    """Form and league ranks of every entity on every given (season, as_of) date.

    ``league`` bounds the entities of a season, ``days`` the (season, as_of) rows; what the
    caller does not know is counted first. With ``many`` entities, snapshots and dates are stored; where the ranks of all
    values fit a broadcast, snapshots look up theirs before they are laid out by date, so the grid is neither shuffled nor sorted.
    """
    columns = [
        *spec.keys, AS_OF, spec.date, spec.id, *spec.carry, *spec.form_columns, *spec.rank_columns,
        *([f"games_last_{n}" for n in spec.windows] if counts else []),
    ]
    if many:
        snaps, as_of = kept(snapshots(df, spec, counts, seasons_are_short(df, spec)), "snapshots"), kept(_dates(as_of, spec), "dates")
        days = as_of.count()
        if days <= BROADCAST_DATES and _few_ranks(snaps, as_of, spec):
            return _ranked_grid(snaps, as_of, spec, days).select(columns)
    else:
        snaps = snapshots(df, spec, counts)
    bounded = entities_fit_window(df, spec) if league is None else league <= max_group_rows(df.sparkSession)
    grid = as_of_grid(snaps, as_of, spec, days)
    return league_ranks(grid, spec, bounded).select(columns)


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: str = "one") -> DataFrame:
    """Newest row per key. ``ties="all"`` keeps every row that shares the newest order value.

    Spark drops older rows map-side before the shuffle. With all ties kept, the newest value
    per key is found first and joined back, so a group of ties never sits in one task.
    """
    if ties == "all":
        tops = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_top"))
        tops = tops.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in order])
        return null_safe_join(df, tops, [*keys, *order])
    window = W.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def record_before_game(games: DataFrame) -> DataFrame:
    """Wins and losses of each team before the date of a game, from final games only.

    A game record may count its own result; these columns cannot. Results are summed per
    team and day first, so the running total is over days, not games.
    """
    side = lambda s, o: games.where("DetailedState = 'Final'").select(
        F.col(f"{s}TeamName").alias("team_name"),
        F.col("Season").alias("season"),
        F.col("OfficialDate").alias("officialdate"),
        (F.col(f"{s}Runs") > F.col(f"{o}Runs")).cast("int").alias("won"),
        (F.col(f"{s}Runs") < F.col(f"{o}Runs")).cast("int").alias("lost"),
    )
    plays = games.select("Season", "OfficialDate", "HomeTeamName", "AwayTeamName")
    idle = plays.select(
        F.explode(F.array("HomeTeamName", "AwayTeamName")).alias("team_name"),
        F.col("Season").alias("season"),
        F.col("OfficialDate").alias("officialdate"),
        F.lit(0).alias("won"),
        F.lit(0).alias("lost"),
    )
    daily = (
        side("Home", "Away").unionByName(side("Away", "Home")).unionByName(idle)
        .groupBy("team_name", "season", "officialdate")
        .agg(F.sum("won").alias("won"), F.sum("lost").alias("lost"))
    )
    before = W.partitionBy("team_name", "season").orderBy("officialdate").rowsBetween(W.unboundedPreceding, -1)
    record = daily.select(
        "team_name", "season", "officialdate",
        F.coalesce(F.sum("won").over(before), F.lit(0)).alias("wins_before"),
        F.coalesce(F.sum("lost").over(before), F.lit(0)).alias("losses_before"),
    )
    out = games
    for name in ("Home", "Away"):
        mine = record.select(
            F.col("team_name").alias(f"{name}TeamName"),
            F.col("season").alias("Season"),
            F.col("officialdate").alias("OfficialDate"),
            F.col("wins_before").alias(f"{name}WinsBefore"),
            F.col("losses_before").alias(f"{name}LossesBefore"),
        )
        out = null_safe_join(out, mine, [f"{name}TeamName", "Season", "OfficialDate"], "left")
    return out
