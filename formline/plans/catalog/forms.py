"""Trailing averages, as-of form, ranks, matchups and model tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.operators import datasets, form, matchup, ranks
from formline.operators.form import PITCHER_FORM, TEAM_FORM, FormSpec
from formline.plans import star
from formline.plans.catalog.registry import query

ORDERS = {
    "team": "officialdate DESC NULLS LAST, id DESC NULLS LAST, runs DESC NULLS LAST, batting_avg DESC NULLS LAST, "
    "strikeouts DESC NULLS LAST, walks DESC NULLS LAST",
    "player": "officialdate DESC NULLS LAST, id DESC NULLS LAST, strikeouts DESC NULLS LAST, runs DESC NULLS LAST",
}


def _average(measure: str, n: int, partition: str, order: str) -> str:
    avg = (
        f"avg({measure}) OVER (PARTITION BY {partition}, season ORDER BY {order} "
        f"ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)"
    )
    return f"round({avg}, 12)" if measure == "batting_avg" else avg


def _averages(spec: FormSpec, order: str) -> str:
    (entity,) = spec.entity
    return ", ".join(
        f"{_average(m, n, entity, order)} AS {m}_last_{n}" for n in spec.windows for m in spec.measures
    )


def ranks_sql(spec: FormSpec) -> str:
    return ", ".join(
        f"CAST(rank() OVER (PARTITION BY as_of, season ORDER BY {c} DESC NULLS LAST) AS INTEGER) AS rank_{c}"
        for c in spec.form_columns
    )


TEAM_COLUMNS = ", ".join(TEAM_FORM.form_columns)
PITCHER_COLUMNS = ", ".join(PITCHER_FORM.form_columns)
TEAM_RANKS = ", ".join(TEAM_FORM.rank_columns)

# Built from every row's averages, so independent of how the Spark side limits rows per date.
FORM_CTES = {
    "team_trailing": f"SELECT *, {_averages(TEAM_FORM, ORDERS['team'])}, row_number() OVER (PARTITION BY team_name, "
    f"season, officialdate ORDER BY {ORDERS['team']}) AS nth FROM team_measures",
    "team_snaps": "SELECT * FROM team_trailing WHERE nth = 1",
    "pitcher_trailing": f"SELECT *, {_averages(PITCHER_FORM, ORDERS['player'])}, row_number() OVER (PARTITION BY "
    f"player_name, season, officialdate ORDER BY {ORDERS['player']}) AS nth FROM pitcher_measures",
    "pitcher_snaps": "SELECT * FROM pitcher_trailing WHERE nth = 1",
    "all_dates": "SELECT DISTINCT Season AS season, OfficialDate AS as_of FROM games",
    "final_dates": "SELECT DISTINCT Season AS season, OfficialDate AS as_of FROM final_games",
    "wanted_teams": "SELECT DISTINCT t.season, t.as_of, t.team_name FROM (SELECT Season AS season, OfficialDate AS as_of, "
    "HomeTeamName AS team_name FROM games UNION ALL SELECT Season, OfficialDate, AwayTeamName FROM games) t",
    "wanted_pitchers": "SELECT DISTINCT t.season, t.as_of, t.player_name FROM (SELECT Season AS season, OfficialDate AS "
    "as_of, HomeProbPitcherFullName AS player_name FROM games UNION ALL SELECT Season, OfficialDate, "
    "AwayProbPitcherFullName FROM games) t",
    "team_as_of": f"SELECT w.team_name, w.season, w.as_of, s.officialdate, s.id, {TEAM_COLUMNS} FROM wanted_teams w "
    "ASOF JOIN team_snaps s ON w.team_name = s.team_name AND w.season = s.season AND w.as_of > s.officialdate",
    "pitcher_as_of": f"SELECT w.player_name, w.season, w.as_of, s.officialdate, s.id, s.team_name, {PITCHER_COLUMNS} FROM "
    "wanted_pitchers w ASOF JOIN pitcher_snaps s ON w.player_name = s.player_name AND w.season = s.season "
    "AND w.as_of > s.officialdate",
    "team_seasons": "SELECT DISTINCT team_name, season FROM team_measures",
    "player_seasons": "SELECT DISTINCT player_name, season FROM pitcher_measures",
}


def grid_sql(dates: str) -> str:
    return (
        f"SELECT e.team_name, e.season, d.as_of, s.officialdate, s.id, {TEAM_COLUMNS} FROM {dates} d "
        "JOIN team_seasons e ON d.season = e.season ASOF JOIN team_snaps s ON e.team_name = s.team_name "
        "AND e.season = s.season AND d.as_of > s.officialdate"
    )


FORM_CTES |= {
    "all_grid": grid_sql("all_dates"),
    "final_grid": grid_sql("final_dates"),
    "all_ranked": f"SELECT *, {ranks_sql(TEAM_FORM)} FROM all_grid",
    "final_ranked": f"SELECT *, {ranks_sql(TEAM_FORM)} FROM final_grid",
    "player_grid": f"SELECT e.player_name, e.season, d.as_of, s.officialdate, s.id, s.team_name, {PITCHER_COLUMNS} FROM "
    "all_dates d JOIN player_seasons e ON d.season = e.season ASOF JOIN pitcher_snaps s ON e.player_name = s.player_name "
    "AND e.season = s.season AND d.as_of > s.officialdate",
    "player_ranked": f"SELECT *, {ranks_sql(PITCHER_FORM)} FROM player_grid",
}


def _prefixed(alias: str, prefix: str, columns: list[str]) -> str:
    return ", ".join(f"{alias}.{c} AS {prefix}{c}" for c in columns)


_TEAM_OUT = ["team_name", "season", "officialdate", "id", *TEAM_FORM.form_columns, *TEAM_FORM.rank_columns]
_PITCHER_OUT = ["player_name", "season", "officialdate", "id", "team_name", *PITCHER_FORM.form_columns, *PITCHER_FORM.rank_columns]


def matchup_sql(source: str, ranked: str) -> str:
    def on(alias: str, key: str, column: str) -> str:
        return f"ON g.{key} = {alias}.{column} AND g.Season = {alias}.season AND g.OfficialDate = {alias}.as_of"

    return f"""
      SELECT g.*, {_prefixed('h', 'home_', _TEAM_OUT)}, {_prefixed('a', 'away_', _TEAM_OUT)},
        {_prefixed('hp', 'home_sp_', _PITCHER_OUT)}, {_prefixed('ap', 'away_sp_', _PITCHER_OUT)}
      FROM {source} g
      LEFT JOIN {ranked} h {on('h', 'HomeTeamName', 'team_name')}
      LEFT JOIN {ranked} a {on('a', 'AwayTeamName', 'team_name')}
      LEFT JOIN player_ranked hp {on('hp', 'HomeProbPitcherFullName', 'player_name')}
      LEFT JOIN player_ranked ap {on('ap', 'AwayProbPitcherFullName', 'player_name')}"""


FORM_CTES["final_matchup"] = matchup_sql("final_games", "final_ranked")
FORM_CTES["reporting"] = (
    "SELECT " + ", ".join(f"{f} AS {f}" for f in datasets.reporting_fields())
    + " FROM final_matchup WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in datasets.reporting_fields())
)
FORM_CTES["derived"] = """
  SELECT *, CAST(HomeWins AS DOUBLE) / (HomeLosses + 1) AS home_win_loss_ratio,
    CAST(AwayWins AS DOUBLE) / (AwayLosses + 1) AS away_win_loss_ratio,
    CAST(HomeWins AS DOUBLE) / (AwayWins + 1) AS home_to_away_wins,
    CAST(HomeLosses AS DOUBLE) / (AwayLosses + 1) AS home_to_away_losses,
    CAST(OfficialDate - home_sp_officialdate AS INTEGER) AS home_sp_days_rest,
    CAST(OfficialDate - away_sp_officialdate AS INTEGER) AS away_sp_days_rest,
    CAST(month(OfficialDate) AS INTEGER) AS game_month,
    CAST(OfficialDate - home_officialdate AS INTEGER) AS home_days_rest,
    CAST(OfficialDate - away_officialdate AS INTEGER) AS away_days_rest,
    CASE WHEN HomeRuns > AwayRuns THEN 1 ELSE 0 END AS HomeTeamWin
  FROM reporting"""


def form_query(name: str, sql: str | None = None):
    return query(name, sql, FORM_CTES)


def _teams(spark, sf):
    return form.team_measures(star.team_batting(spark, sf))


def _pitchers(spark, sf):
    return form.pitcher_measures(star.individual_pitching(spark, sf))


def _bounds(spark, sf):
    return {"league": star.league_size(spark, sf), "days": star.game_days(spark, sf)}


@form_query(
    "trailing_avg_team",
    f"SELECT team_name, season, officialdate, id, runs, batting_avg, strikeouts, walks, {TEAM_COLUMNS} FROM team_trailing",
)
def trailing_avg_team(spark, sf):
    return form.trailing_rows(_teams(spark, sf), TEAM_FORM, derived=True)


@form_query(
    "trailing_avg_pitcher",
    f"SELECT player_name, season, officialdate, id, team_name, strikeouts, runs, {PITCHER_COLUMNS} FROM pitcher_trailing",
)
def trailing_avg_pitcher(spark, sf):
    return form.trailing_rows(_pitchers(spark, sf).select(*PITCHER_FORM.source_columns), PITCHER_FORM)


@form_query(
    "games_back_rank",
    "SELECT team_name, season, officialdate, id, CAST(rank() OVER (PARTITION BY team_name, season ORDER BY officialdate "
    "DESC NULLS LAST) AS INTEGER) AS games_back FROM team_measures",
)
def games_back_rank(spark, sf):
    rows = _teams(spark, sf).select("team_name", "season", "officialdate", "id")
    return ranks.rank_within(rows, ["team_name", "season"], "officialdate", "games_back", derived=True)


@form_query("batting_average", "SELECT id, batting_avg FROM team_measures")
def batting_average(spark, sf):
    return _teams(spark, sf).select("id", "batting_avg")


@form_query("walks_total", "SELECT id, walks FROM team_measures")
def walks_total(spark, sf):
    return _teams(spark, sf).select("id", "walks")


_LATEST = "SELECT * EXCLUDE (nth) FROM (SELECT *, {0} AS nth FROM {1}) WHERE nth = 1"


@form_query(
    "latest_by_id",
    _LATEST.format("rank() OVER (PARTITION BY team_name, season ORDER BY officialdate DESC, id DESC)", "team_measures"),
)
def latest_by_id(spark, sf):
    return form.latest_rows(_teams(spark, sf), ["team_name", "season"], ["officialdate", "id"])


@form_query(
    "latest_by_date",
    _LATEST.format("rank() OVER (PARTITION BY player_name, season ORDER BY officialdate DESC)", "pitcher_measures"),
)
def latest_by_date(spark, sf):
    return form.latest_rows(_pitchers(spark, sf), ["player_name", "season"], ["officialdate"], ties="all")


@form_query(
    "top1_per_group",
    _LATEST.format(
        f"row_number() OVER (PARTITION BY player_name, season ORDER BY {ORDERS['player']})",
        "(SELECT player_name, season, officialdate, id, strikeouts, runs FROM pitcher_measures)",
    ),
)
def top1_per_group(spark, sf):
    rows = _pitchers(spark, sf).select("player_name", "season", "officialdate", "id", "strikeouts", "runs")
    return form.latest_rows(rows, ["player_name", "season"], ["officialdate", "id", "strikeouts", "runs"])


@form_query("asof_join_strict", f"SELECT team_name, season, as_of, officialdate, id, {TEAM_COLUMNS} FROM team_as_of")
def asof_join_strict(spark, sf):
    wanted = matchup.wanted_dates(star.games(spark, sf), TEAM_FORM)
    return form.last_before(wanted, form.snapshots(_teams(spark, sf), TEAM_FORM), TEAM_FORM)


@form_query(
    "league_rank_team",
    f"SELECT team_name, season, as_of, officialdate, id, {TEAM_COLUMNS}, {TEAM_RANKS} FROM all_ranked",
)
def league_rank_team(spark, sf):
    return matchup.team_form_for(star.games(spark, sf), _teams(spark, sf), **_bounds(spark, sf))


@form_query(
    "league_rank_pitcher",
    f"SELECT player_name, season, as_of, officialdate, id, team_name, {PITCHER_COLUMNS}, {ranks_sql(PITCHER_FORM)} FROM player_grid",
)
def league_rank_pitcher(spark, sf):
    pitchers = _pitchers(spark, sf)
    dates = star.games(spark, sf).select(F.col("Season").alias("season"), F.col("OfficialDate").alias("as_of"))
    league = star.table(spark, sf, "supplier").count()
    return form.ranked_form(pitchers, dates, PITCHER_FORM, league=league, many=True)


@form_query(
    "stack_metrics",
    "SELECT * FROM (SELECT team_name, season, officialdate, id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in TEAM_FORM.form_columns)
    + f" FROM team_snaps) UNPIVOT INCLUDE NULLS (metric_value FOR metric IN ({TEAM_COLUMNS}))",
)
def stack_metrics(spark, sf):
    snaps = form.snapshots(_teams(spark, sf), TEAM_FORM)
    return ranks.stack_metrics(snaps, ["team_name", "season", "officialdate", "id"], TEAM_FORM.form_columns)


@form_query(
    "join_left_equi",
    "SELECT g.GamePK, g.HomeTeamName, g.AwayTeamName, h.officialdate AS home_officialdate, h.runs_last_7 AS home_runs_last_7, "
    "a.officialdate AS away_officialdate, a.runs_last_7 AS away_runs_last_7 FROM games g "
    "LEFT JOIN team_as_of h ON g.HomeTeamName = h.team_name AND g.Season = h.season AND g.OfficialDate = h.as_of "
    "LEFT JOIN team_as_of a ON g.AwayTeamName = a.team_name AND g.Season = a.season AND g.OfficialDate = a.as_of",
)
def join_left_equi(spark, sf):
    games = star.games(spark, sf)
    found = form.last_before(
        matchup.wanted_dates(games, TEAM_FORM), form.snapshots(_teams(spark, sf), TEAM_FORM), TEAM_FORM
    )
    out = games
    for side in matchup.SIDES:
        out = matchup.join_form(out, found, side, f"{side.lower()}_", TEAM_FORM)
    return out.select(
        "GamePK", "HomeTeamName", "AwayTeamName", "home_officialdate", "home_runs_last_7", "away_officialdate",
        "away_runs_last_7",
    )


@form_query(
    "join_left_pitcher",
    "SELECT g.GamePK, " + _prefixed("hp", "home_sp_", _PITCHER_OUT) + ", " + _prefixed("ap", "away_sp_", _PITCHER_OUT)
    + " FROM games g LEFT JOIN player_ranked hp ON g.HomeProbPitcherFullName = hp.player_name AND g.Season = hp.season "
    "AND g.OfficialDate = hp.as_of LEFT JOIN player_ranked ap ON g.AwayProbPitcherFullName = ap.player_name AND "
    "g.Season = ap.season AND g.OfficialDate = ap.as_of",
)
def join_left_pitcher(spark, sf):
    games = star.games(spark, sf)
    found = matchup.pitcher_form_for(games, _pitchers(spark, sf))
    out = games.select("GamePK", "Season", "OfficialDate", "HomeProbPitcherFullName", "AwayProbPitcherFullName")
    for side in matchup.SIDES:
        out = matchup.join_form(out, found, side, f"{side.lower()}_sp_", PITCHER_FORM)
    return out.drop("Season", "OfficialDate", "HomeProbPitcherFullName", "AwayProbPitcherFullName")


@form_query("assemble_matchup", matchup_sql("games", "all_ranked"))
def assemble_matchup(spark, sf):
    return matchup.assemble_matchup(
        star.games(spark, sf), star.team_batting(spark, sf), star.individual_pitching(spark, sf), **_bounds(spark, sf),
        dates=star.game_dates(spark, sf), pitchers=star.table(spark, sf, "supplier").count(),
    )


def final_matchup(spark, sf):
    """What the model tables are made of: none of their features is a pitcher's rank."""
    return matchup.assemble_matchup(
        star.final_games(spark, sf), star.team_batting(spark, sf), star.individual_pitching(spark, sf),
        pitcher_ranks=False, dates=star.game_dates(spark, sf), **_bounds(spark, sf),
    )


_RECORD = """
  SELECT t.team_name, t.season, t.officialdate, sum(t.won) AS won, sum(t.lost) AS lost FROM (
    SELECT HomeTeamName AS team_name, Season AS season, OfficialDate AS officialdate,
      CAST(HomeRuns > AwayRuns AS INTEGER) AS won, CAST(HomeRuns < AwayRuns AS INTEGER) AS lost FROM final_games
    UNION ALL SELECT AwayTeamName, Season, OfficialDate, CAST(AwayRuns > HomeRuns AS INTEGER),
      CAST(AwayRuns < HomeRuns AS INTEGER) FROM final_games) t GROUP BY ALL"""


def _record_sum(column: str, side: str) -> str:
    return (
        f"CAST(coalesce((SELECT sum(r.{column}) FROM record r WHERE r.team_name = g.{side}TeamName AND r.season = g.Season "
        "AND r.officialdate < g.OfficialDate), 0) AS BIGINT)"
    )


@query(
    "record_before_game",
    f"SELECT GamePK, {_record_sum('won', 'Home')} AS HomeWinsBefore, {_record_sum('lost', 'Home')} AS HomeLossesBefore, "
    f"{_record_sum('won', 'Away')} AS AwayWinsBefore, {_record_sum('lost', 'Away')} AS AwayLossesBefore FROM games g",
    {"record": _RECORD},
)
def record_before_game(spark, sf):
    return form.record_before_game(star.games(spark, sf)).select(
        "GamePK", "HomeWinsBefore", "HomeLossesBefore", "AwayWinsBefore", "AwayLossesBefore"
    )


@form_query("reporting_fields", "SELECT " + ", ".join(f"{f} AS {f}" for f in datasets.reporting_fields()) + " FROM final_matchup")
def reporting_fields(spark, sf):
    return final_matchup(spark, sf).select(datasets.reporting_fields())


@form_query("drop_null_rows", "SELECT * FROM reporting")
def drop_null_rows(spark, sf):
    return datasets.complete_rows(final_matchup(spark, sf))


@form_query(
    "dataset_home_win",
    "SELECT GamePK, Season AS season, " + ", ".join(f"{c} AS {c}" for c in datasets.HOME_WIN_FEATURES)
    + ", HomeTeamWin FROM derived",
)
def dataset_home_win(spark, sf):
    return datasets.dataset_home_win(final_matchup(spark, sf))


def _runs_sql(side: str) -> str:
    columns = ", ".join(
        f"{c} AS {c.replace(f'{side}_', 'own_', 1) if c.startswith(side + '_') else c.replace('home_', 'other_', 1).replace('away_', 'other_', 1)}"
        for c in datasets.runs_features(side)
    )
    return f"SELECT '{side}' AS side, GamePK, Season AS season, {columns}, {side.capitalize()}Runs AS side_runs FROM derived"


def _runs_columns(side: str):
    out = []
    for c in datasets.runs_features(side):
        if c.startswith(f"{side}_"):
            name = c.replace(f"{side}_", "own_", 1)
        else:
            name = c.replace("home_", "other_", 1).replace("away_", "other_", 1)
        out.append(F.col(c).alias(name))
    return out


@form_query("dataset_runs_by_side", _runs_sql("away") + " UNION ALL BY NAME " + _runs_sql("home"))
def dataset_runs_by_side(spark, sf):
    """Both tables under common names: ``own_`` and ``other_`` for the side's and the opponent's columns."""
    away, home = datasets.dataset_runs_by_side(final_matchup(spark, sf))
    parts = [
        df.select(F.lit(s).alias("side"), "GamePK", "season", *_runs_columns(s), F.col(f"{s.capitalize()}Runs").alias("side_runs"))
        for s, df in (("away", away), ("home", home))
    ]
    return parts[0].unionByName(parts[1])


@form_query(
    "column_concat_by_row",
    "SELECT GamePK, Season AS season, home_win_loss_ratio, home_days_rest, HomeTeamWin FROM derived",
)
def column_concat_by_row(spark, sf):
    """Features and label come from one row, so nothing is glued by row order."""
    rows = datasets.dataset_home_win(final_matchup(spark, sf))
    return rows.select("GamePK", "season", "home_win_loss_ratio", "home_days_rest", "HomeTeamWin")
