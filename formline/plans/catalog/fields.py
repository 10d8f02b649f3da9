"""Scalar operators, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.functions import scalars, zones
from formline.operators import columns, datasets, metrics
from formline.operators.flatten import UNKNOWN_PITCHER_NAME
from formline.plans import star
from formline.plans.catalog.registry import query
from formline.plans.star import TEST_SEASON, VALIDATION_SEASON

AS_OF_DAY = "1998-07-04"


@query("prefix_columns", "SELECT " + ", ".join(f"{c} AS home_{c}" for c in (
    "team_name", "season", "officialdate", "id", "runs", "hits", "atbats", "strikeouts", "baseonballs", "intentionalwalks",
    "detailedstate")) + " FROM team_batting")
def prefix_columns(spark, sf):
    return columns.prefix_columns("home_", star.team_batting(spark, sf))


@query("project_list", "SELECT team_name, season, officialdate, id, runs, strikeouts FROM team_batting")
def project_list(spark, sf):
    return star.team_batting(spark, sf).select("team_name", "season", "officialdate", "id", "runs", "strikeouts")


@query("project_by_position", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def project_by_position(spark, sf):
    """Two stray index columns, dropped by name."""
    stray = star.table(spark, sf, "customer").withColumns({"_c0": F.lit(0), "Unnamed: 0": F.lit(0)})
    return columns.drop_index_columns(stray)


@query("drop_columns", "SELECT * EXCLUDE (runs, strikeouts, baseonballs) FROM team_batting")
def drop_columns(spark, sf):
    return star.team_batting(spark, sf).drop("runs", "strikeouts", "baseonballs")


@query("filter_season", "SELECT * FROM team_batting WHERE season = 1998")
def filter_season(spark, sf):
    return star.team_batting(spark, sf).where(F.col("season") == 1998)


@query("filter_date_eq", f"SELECT * FROM games WHERE OfficialDate = DATE '{AS_OF_DAY}'")
def filter_date_eq(spark, sf):
    return star.games(spark, sf).where(F.col("OfficialDate") == F.lit(AS_OF_DAY).cast("date"))


@query("filter_before_date", f"SELECT * FROM team_batting WHERE officialdate < DATE '{AS_OF_DAY}'")
def filter_before_date(spark, sf):
    return star.team_batting(spark, sf).where(F.col("officialdate") < F.lit(AS_OF_DAY).cast("date"))


@query("filter_final_state", "SELECT * FROM individual_pitching WHERE detailedstate = 'Final'")
def filter_final_state(spark, sf):
    return star.individual_pitching(spark, sf).where("detailedstate = 'Final'")


_SPLIT = (
    f"CASE WHEN season < {VALIDATION_SEASON} THEN 'train' WHEN season = {VALIDATION_SEASON} THEN 'validation' "
    f"WHEN season = {TEST_SEASON} THEN 'test' END"
)


@query("season_split", f"SELECT *, {_SPLIT} AS dataset FROM predictions")
def season_split(spark, sf):
    return datasets.season_split(star.predictions(spark, sf), VALIDATION_SEASON, TEST_SEASON)


@query(
    "union_splits",
    f"SELECT * FROM (SELECT *, {_SPLIT} AS dataset FROM predictions) WHERE dataset IS NOT NULL",
)
def union_splits(spark, sf):
    """Splits are values of one column, so their union is the tagged table without later seasons."""
    return datasets.season_split(star.predictions(spark, sf), VALIDATION_SEASON, TEST_SEASON).where("dataset is not null")


@query(
    "win_loss_ratio",
    "SELECT GamePK, CAST(HomeWins AS DOUBLE) / (HomeLosses + 1) AS home_win_loss_ratio, CAST(AwayWins AS DOUBLE) / "
    "(AwayLosses + 1) AS away_win_loss_ratio FROM games",
)
def win_loss_ratio(spark, sf):
    return star.games(spark, sf).select(
        "GamePK", scalars.win_loss_ratio("HomeWins", "HomeLosses").alias("home_win_loss_ratio"),
        scalars.win_loss_ratio("AwayWins", "AwayLosses").alias("away_win_loss_ratio"),
    )


@query(
    "cross_team_ratio",
    "SELECT GamePK, CAST(HomeWins AS DOUBLE) / (AwayWins + 1) AS home_to_away_wins, CAST(HomeLosses AS DOUBLE) / "
    "(AwayLosses + 1) AS home_to_away_losses FROM games",
)
def cross_team_ratio(spark, sf):
    return star.games(spark, sf).select(
        "GamePK", scalars.cross_team_ratio("HomeWins", "AwayWins").alias("home_to_away_wins"),
        scalars.cross_team_ratio("HomeLosses", "AwayLosses").alias("home_to_away_losses"),
    )


@query(
    "days_rest",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS "
    "INTEGER) AS days_rest FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def days_rest(spark, sf):
    lines, orders = star.table(spark, sf, "lineitem"), star.table(spark, sf, "orders")
    return lines.join(orders, F.expr("l_orderkey = o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scalars.days_rest("l_shipdate", "o_orderdate").alias("days_rest")
    )


@query("game_month", "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS game_month FROM orders")
def game_month(spark, sf):
    return star.table(spark, sf, "orders").select("o_orderkey", scalars.game_month("o_orderdate").alias("game_month"))


@query(
    "home_win_flag",
    "SELECT GamePK, CASE WHEN HomeRuns > AwayRuns THEN 1 ELSE 0 END AS HomeTeamWin, CASE WHEN DetailedState = 'Final' THEN "
    "CASE WHEN HomeRuns > AwayRuns THEN 1 ELSE 0 END END AS home_win_label FROM games",
)
def home_win_flag(spark, sf):
    return star.games(spark, sf).select(
        "GamePK", scalars.home_win_flag("HomeRuns", "AwayRuns").alias("HomeTeamWin"),
        scalars.home_win_label("HomeRuns", "AwayRuns", "DetailedState").alias("home_win_label"),
    )


@query("round1", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_discount, 1) AS rounded FROM lineitem")
def round1(spark, sf):
    return star.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", scalars.round1("l_discount").alias("rounded")
    )


@query(
    "threshold_flag",
    "SELECT *, CASE WHEN model_prediction > 0.5::DOUBLE THEN 1 ELSE 0 END AS pred_binary FROM predictions",
)
def threshold_flag(spark, sf):
    return star.predictions(spark, sf).withColumn("pred_binary", scalars.threshold_flag("model_prediction"))


@query(
    "correct_flag",
    "SELECT *, CASE WHEN (model_prediction > 0.5::DOUBLE) = (HomeTeamWin = 1) THEN 1 ELSE 0 END AS correct FROM predictions",
)
def correct_flag(spark, sf):
    return star.predictions(spark, sf).withColumn(
        "correct", scalars.correct_flag(scalars.threshold_flag("model_prediction"), "HomeTeamWin")
    )


@query(
    "label_predictions",
    "SELECT *, round(model_prediction, 1) AS rounded, CASE WHEN model_prediction > 0.5::DOUBLE THEN 1 ELSE 0 END AS pred_binary, "
    "CASE WHEN (model_prediction > 0.5::DOUBLE) = (HomeTeamWin = 1) THEN 1 ELSE 0 END AS correct FROM predictions",
)
def label_predictions(spark, sf):
    return metrics.label_predictions(star.predictions(spark, sf))


@query(
    "yrmo",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || CASE WHEN month(o_orderdate) < 10 THEN '0' ELSE '' END || "
    "CAST(month(o_orderdate) AS VARCHAR) AS yrmo FROM orders",
)
def yrmo(spark, sf):
    return star.table(spark, sf, "orders").select("o_orderkey", scalars.yrmo(F.year("o_orderdate"), F.month("o_orderdate")).alias("yrmo"))


@query("ratio_pct", "SELECT l_orderkey, CAST(runs AS DOUBLE) / nullif(n_lines, 0) AS pct FROM order_lines")
def ratio_pct(spark, sf):
    return star.order_lines(spark, sf).select("l_orderkey", scalars.ratio_pct("runs", "n_lines").alias("pct"))


@query("to_date", "SELECT event_id, CAST(ts AS DATE) AS event_date FROM events")
def to_date(spark, sf):
    return star.table(spark, sf, "events").select("event_id", scalars.to_day("ts").alias("event_date"))


@query(
    "utc_to_zone_fixed",
    "SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS eastern FROM events",
)
def utc_to_zone_fixed(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return star.table(spark, sf, "events").select(
        "event_id", zones.utc_to_zone(ts, zones.EASTERN).cast("timestamp_ntz").alias("eastern")
    )


_EVENT_ZONES = "(VALUES ('error', 'America/Chicago'), ('click', 'America/Denver'), ('view', 'America/Phoenix')) z(kind, tz)"


@query(
    "utc_to_zone_by_row",
    f"SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE coalesce(tz, 'UTC') AS local_time FROM events LEFT JOIN {_EVENT_ZONES} "
    "ON event_type = kind",
)
def utc_to_zone_by_row(spark, sf):
    dim = zones.zone_table(spark, {"error": "America/Chicago", "click": "America/Denver", "view": "America/Phoenix"})
    zoned = zones.dim_lookup(star.table(spark, sf, "events"), dim, "event_type", "team", "tz", zones.DEFAULT_ZONE)
    return zoned.select(
        "event_id", zones.utc_to_zone(F.col("ts").cast("timestamp"), F.col("tz")).cast("timestamp_ntz").alias("local_time")
    )


@query(
    "dim_lookup",
    "SELECT c_custkey, c_name, coalesce(tz, 'UTC') AS tz FROM customer LEFT JOIN team_zones ON c_name = team",
)
def dim_lookup(spark, sf):
    customers = star.table(spark, sf, "customer").select("c_custkey", "c_name")
    return zones.dim_lookup(customers, star.team_zones(spark, sf), "c_name", "team", "tz", zones.DEFAULT_ZONE)


@query("batch_stamp", "SELECT o_orderkey, TIMESTAMP '2001-09-01 06:00:00' AS batch FROM orders")
def batch_stamp(spark, sf):
    rows = star.table(spark, sf, "orders").select("o_orderkey")
    return scalars.batch_stamp(rows, F.lit("2001-09-01 06:00:00").cast("timestamp_ntz"))


@query("constant_tag", "SELECT o_orderkey, 'home' AS team_type FROM orders")
def constant_tag(spark, sf):
    return star.table(spark, sf, "orders").select("o_orderkey", F.lit("home").alias("team_type"))


@query(
    "sentinel_default",
    "SELECT o_orderkey, coalesce(s_suppkey, -999) AS pitcher_id, coalesce(s_name, 'unannounced') AS pitcher_name FROM orders "
    "LEFT JOIN order_lines ON o_orderkey = l_orderkey LEFT JOIN supplier ON first_supp = s_suppkey",
)
def sentinel_default(spark, sf):
    joined = (
        star.table(spark, sf, "orders")
        .join(star.order_lines(spark, sf), F.expr("o_orderkey = l_orderkey"), "left")
        .join(star.table(spark, sf, "supplier"), F.expr("first_supp = s_suppkey"), "left")
    )
    return joined.select(
        "o_orderkey", scalars.sentinel_default("s_suppkey", F.lit(-999).cast("bigint")).alias("pitcher_id"),
        scalars.sentinel_default("s_name", UNKNOWN_PITCHER_NAME).alias("pitcher_name"),
    )


@query(
    "date_series",
    "SELECT d.season, d.officialdate, strftime(d.officialdate, '%Y-%m-%d') || 'T10:00:00Z' AS snapshot_time FROM (SELECT season, "
    "CAST(unnest(generate_series(CAST(b AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS officialdate FROM "
    "(SELECT CAST(year(o_orderdate) AS INTEGER) AS season, CAST(min(o_orderdate) AS DATE) AS b, CAST(max(o_orderdate) AS DATE) "
    "AS e FROM orders GROUP BY 1)) d",
)
def date_series(spark, sf):
    """Every day of each season, from its first to its last game."""
    seasons = star.table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("season")).agg(
        F.to_date(F.min("o_orderdate")).alias("b"), F.to_date(F.max("o_orderdate")).alias("e")
    )
    days = seasons.select("season", F.explode(F.sequence("b", "e")).alias("officialdate"))
    return days.withColumn("snapshot_time", scalars.iso_at_ten("officialdate"))


@query("season_of", "SELECT o_orderkey, CAST(substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) AS INTEGER) AS season FROM orders")
def season_of(spark, sf):
    return star.table(spark, sf, "orders").select(
        "o_orderkey", scalars.season_of(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("season")
    )


@query("strip_dashes", "SELECT o_orderkey, replace(strftime(o_orderdate, '%Y-%m-%d'), '-', '') AS day FROM orders")
def strip_dashes(spark, sf):
    return star.table(spark, sf, "orders").select("o_orderkey", scalars.strip_dashes("o_orderdate").alias("day"))
