"""Games with the form of both teams and both probable pitchers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.operators.blocks import max_group_rows
from formline.operators.columns import prefix_columns
from formline.operators.form import (
    AS_OF, PITCHER_FORM, TEAM_FORM, FormSpec, entities_fit_window, form_before, pitcher_measures, ranked_form,
    ranked_wanted, team_measures, trailing_rows, with_ties,
)

# Column of a game that names the entity, by side and kind of entity key.
GAME_KEYS = {
    "team_name": "{side}TeamName",
    "team_id": "{side}TeamID",
    "player_name": "{side}ProbPitcherFullName",
    "player_id": "{side}ProbPitcherID",
}
SIDES = ("Home", "Away")
#: Rows of the teams' form that may be sent to every executor, some 300 bytes each.
BROADCAST_FORMS = 200_000


def wanted_dates(games: DataFrame, spec: FormSpec) -> DataFrame:
    """The (entity, season, as_of) combinations the games ask for, both sides, each once."""
    (entity,) = spec.entity
    sides = F.array(*[F.col(GAME_KEYS[entity].format(side=s)) for s in SIDES])
    return games.select(
        F.explode(sides).alias(entity), F.col("Season").alias(spec.season), F.col("OfficialDate").alias(AS_OF)
    ).distinct()


def as_of_dates(games: DataFrame, spec: FormSpec) -> DataFrame:
    return games.select(F.col("Season").alias(spec.season), F.col("OfficialDate").alias(AS_OF)).distinct()


def join_form(games: DataFrame, form: DataFrame, side: str, prefix: str, spec: FormSpec) -> DataFrame:
    """Left join of one side's form on entity, season and date; games without form keep NULLs.

    Plain equi keys: Spark broadcasts a small form table by its measured size and splits skewed
    partitions of a large one.
    """
    (entity,) = spec.entity
    right = prefix_columns(prefix, form)
    condition = (
        (games[GAME_KEYS[entity].format(side=side)] == right[prefix + entity])
        & (games["Season"] == right[prefix + spec.season])
        & (games["OfficialDate"] == right[prefix + AS_OF])
    )
    return games.join(right, condition, "left").drop(prefix + AS_OF)


def team_form_for(
    games: DataFrame, batting: DataFrame, spec: FormSpec = TEAM_FORM, league: int | None = None, days: int | None = None
) -> DataFrame:
    """Form with ranks of all teams on all game dates; of ``games`` only season and date are read."""
    return ranked_form(batting, as_of_dates(games, spec), spec, league=league, days=days)


def pitcher_form_for(
    games: DataFrame, pitching: DataFrame, spec: FormSpec = PITCHER_FORM, ranks: bool = True, ties: str = "one",
    days: int | None = None, pitchers: int | None = None, dates: DataFrame | None = None,
) -> DataFrame:
    """Form of the probable pitchers on their game dates.

    Ranks are among all pitchers of a date; only the pitchers asked for are looked up.
    ``pitchers`` is an upper bound of the pitchers of a season, where known, ``dates`` as in ``assemble_matchup``. With
    either, snapshots are stored and their ranks looked up; else the plan reads its tables alone, by their partitions.
    """
    if ranks:
        bounded = entities_fit_window(pitching, spec) if pitchers is None else pitchers <= max_group_rows(games.sparkSession)
        as_of = as_of_dates(games if dates is None else dates, spec)
        if bounded:
            derived = dates is not None or pitchers is not None
            found = ranked_wanted(pitching, wanted_dates(games, spec), as_of, spec, days, derived=derived)
        else:
            found = ranked_form(pitching, as_of, spec, league=pitchers, days=days)
    else:
        found = form_before(wanted_dates(games, spec), pitching, spec)
    if ties == "all":
        rows = with_ties(found, trailing_rows(pitching.select(*spec.source_columns), spec), spec)
        return rows if not ranks else rows.join(found.select(*spec.keys, AS_OF, *spec.rank_columns), [*spec.keys, AS_OF])
    return found


def assemble_matchup(
    games: DataFrame,
    batting: DataFrame,
    pitching: DataFrame,
    team_spec: FormSpec = TEAM_FORM,
    pitcher_spec: FormSpec = PITCHER_FORM,
    completed_only: bool = True,
    pitcher_ranks: bool = True,
    pitcher_ties: str = "one",
    league: int | None = None,
    days: int | None = None,
    pitchers: int | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Games with columns ``home_*``, ``away_*``, ``home_sp_*`` and ``away_sp_*``, ranks included.

    Form is taken strictly before the game's date: the second game of a day does not see the first.
    ``league``, ``pitchers`` and ``days`` are upper bounds of teams and pitchers per season and of game dates, where known.
    Where games and pitching are costly to compute, ``dates`` is a plainer table with at least the games' ``Season`` and
    ``OfficialDate``; games are then not computed for it. Where pitchers are ranked and either is given, their snapshots are stored.
    """
    teams = team_form_for(games if dates is None else dates, team_measures(batting), team_spec, league, days)
    starters = pitcher_form_for(
        games, pitcher_measures(pitching, completed_only), pitcher_spec, pitcher_ranks, pitcher_ties, days, pitchers, dates
    )
    # Known bounds say that the teams' form is small: then games aren't shuffled for it, at their widest.
    few = league is not None and days is not None and league * days <= BROADCAST_FORMS
    out = games
    # Starters are many and join by a shuffle of the games, so that comes while the rows are narrow.
    for side in SIDES:
        out = join_form(out, starters, side, f"{side.lower()}_sp_", pitcher_spec)
    for side in SIDES:
        out = join_form(out, F.broadcast(teams) if few else teams, side, f"{side.lower()}_", team_spec)
    forms = [(teams, "home_"), (teams, "away_"), (starters, "home_sp_"), (starters, "away_sp_")]
    return out.select(*games.columns, *[p + c for form, p in forms for c in form.columns if c != AS_OF])
