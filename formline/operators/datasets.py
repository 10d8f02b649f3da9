"""Model tables: identifiers, features by name, label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.functions import scalars
from formline.operators.columns import drop_null_rows
from formline.operators.form import PITCHER_FORM, TEAM_FORM
from formline.scratch import kept

ID_COLUMNS = ["GamePK", "season"]
LABEL = "HomeTeamWin"


def _team_form(side: str) -> list[str]:
    return [f"{side}_{c}" for c in TEAM_FORM.form_columns]


def _team_ranks(side: str) -> list[str]:
    return [f"{side}_{c}" for c in TEAM_FORM.rank_columns]


def _pitcher_form(side: str) -> list[str]:
    return [f"{side}_sp_{m}_last_{n}" for m in PITCHER_FORM.measures for n in PITCHER_FORM.windows]


def _pitcher(side: str) -> list[str]:
    return [f"{side}_sp_player_name", f"{side}_sp_officialdate", *_pitcher_form(side)]


def _game_side(side: str) -> list[str]:
    return [f"{side}{c}" for c in (
        "TeamId", "TeamShortName", "ProbPitcherId", "ProbPitcherFullName", "WinningPercentage", "Wins", "Losses"
    )]


def reporting_fields() -> list[str]:
    """The 105 columns a complete matchup row has; a row with a NULL in any of them is not modelled."""
    game = [
        "GamePK", "GameId", "GameNumber", "VenueName", "Season", "OfficialDate",
        "home_officialdate", "away_officialdate", "DayNight", "AwayRuns", "HomeRuns",
    ]
    return [
        *game, *_game_side("Away"), *_game_side("Home"),
        *_team_form("home"), *_team_ranks("home"), *_pitcher("away"),
        *_team_form("away"), *_team_ranks("away"), *_pitcher("home"),
    ]


def derived_columns(df: DataFrame) -> DataFrame:
    """Ratios of the records, days of rest and month of the game."""
    return df.withColumns({
        "home_win_loss_ratio": scalars.win_loss_ratio("HomeWins", "HomeLosses"),
        "away_win_loss_ratio": scalars.win_loss_ratio("AwayWins", "AwayLosses"),
        "home_to_away_wins": scalars.cross_team_ratio("HomeWins", "AwayWins"),
        "home_to_away_losses": scalars.cross_team_ratio("HomeLosses", "AwayLosses"),
        "home_sp_days_rest": scalars.days_rest("OfficialDate", "home_sp_officialdate"),
        "away_sp_days_rest": scalars.days_rest("OfficialDate", "away_sp_officialdate"),
        "game_month": scalars.game_month("OfficialDate"),
        "home_days_rest": scalars.days_rest("OfficialDate", "home_officialdate"),
        "away_days_rest": scalars.days_rest("OfficialDate", "away_officialdate"),
    })


def complete_rows(matchups: DataFrame) -> DataFrame:
    return drop_null_rows(matchups.select(reporting_fields()))


HOME_WIN_FEATURES = [
    "HomeWinningPercentage", "home_to_away_wins", "home_win_loss_ratio", "GameNumber", "game_month",
    "home_days_rest", "away_days_rest", *_team_form("home"), *_team_form("away"),
    *_pitcher_form("home"), "home_sp_days_rest", *_pitcher_form("away"), "away_sp_days_rest",
]


def runs_features(side: str) -> list[str]:
    """Features for one side's runs: its own form against the other side's starter."""
    other = "away" if side == "home" else "home"
    shared = ["home_win_loss_ratio", "away_win_loss_ratio", "GameNumber", "game_month", "home_days_rest", "away_days_rest"]
    return [*shared, *_team_form(side), *_pitcher_form(other), f"{other}_sp_days_rest"]


def dataset_home_win(matchups: DataFrame, label_known: str | None = None) -> DataFrame:
    """Two ids, 53 features and ``HomeTeamWin``.

    ``label_known`` is a boolean SQL expression over the reporting fields; where it is false the
    label is NULL (games not played yet would otherwise count as lost).
    """
    label = scalars.home_win_flag("HomeRuns", "AwayRuns")
    if label_known:
        label = F.when(F.expr(label_known), label)
    rows = derived_columns(complete_rows(matchups))
    return rows.select(*ID_COLUMNS, *HOME_WIN_FEATURES, label.alias(LABEL))


def dataset_runs_by_side(matchups: DataFrame, derived: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two tables, away and home: ids, 29 features and the side's runs.

    Matchups that are costly to compute (``derived``) are computed once, and what both tables read is stored.
    """
    rows = derived_columns(complete_rows(matchups))
    if derived:
        both = dict.fromkeys([*ID_COLUMNS, *runs_features("away"), *runs_features("home"), "AwayRuns", "HomeRuns"])
        rows = kept(rows.select(*both), "runs")
    return tuple(
        rows.select(*ID_COLUMNS, *runs_features(side), target)
        for side, target in (("away", "AwayRuns"), ("home", "HomeRuns"))
    )


def season_split(df: DataFrame, validation: int, test: int, column: str = "season") -> DataFrame:
    """Tag rows as train, validation or test by season, in one pass; later seasons get NULL."""
    season = F.col(column)
    return df.withColumn(
        "dataset",
        F.when(season < validation, "train").when(season == validation, "validation").when(season == test, "test"),
    )
