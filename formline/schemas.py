"""Declared schemas of documents and tables. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

STATS = "map<string,string>"
PERSON = "struct<id:bigint,fullname:string>"
_TEAM = (
    "struct<id:bigint,name:string,shortname:string,league:struct<name:string>,"
    "record:struct<wins:int,losses:int,winningpercentage:double>>"
)
_PLAYER = f"struct<person:{PERSON},position:struct<code:string>,stats:struct<batting:{STATS},pitching:{STATS}>>"
_BOX = (
    f"struct<team:struct<id:bigint,name:string>,teamstats:struct<batting:{STATS},pitching:{STATS}>,"
    f"players:map<string,{_PLAYER}>>"
)
GAME_DOCUMENT = (
    "gamepk bigint, "
    "gamedata struct<"
    "game:struct<id:string,gamenumber:int,season:int>,"
    "datetime:struct<officialdate:date,daynight:string,time:string,ampm:string>,"
    "status:struct<detailedstate:string>,"
    "venue:struct<name:string,location:struct<city:string,state:string>>,"
    f"probablepitchers:struct<away:{PERSON},home:{PERSON}>,"
    f"teams:struct<away:{_TEAM},home:{_TEAM}>>, "
    f"livedata struct<boxscore:struct<teams:struct<home:{_BOX},away:{_BOX}>>>"
)

_OUTCOME = "struct<name:string,price:double>"
_MARKET = f"struct<key:string,last_update:string,outcomes:array<{_OUTCOME}>>"
_BOOKMAKER = f"struct<key:string,title:string,last_update:string,markets:array<{_MARKET}>>"
ODDS_EVENT = (
    "struct<id:string,sport_key:string,sport_title:string,commence_time:string,"
    f"home_team:string,away_team:string,bookmakers:array<{_BOOKMAKER}>>"
)
ODDS_SNAPSHOT = f"data array<{ODDS_EVENT}>"

# Statistics that later jobs use, in the order the tables list them.
BATTING_STATS = ("hits", "atbats", "runs", "strikeouts", "baseonballs", "intentionalwalks")
PITCHING_STATS = ("runs", "strikeouts")

GAMES = (
    "GamePK bigint, GameID string, GameNumber int, VenueName string, VenueCity string, VenueState string, "
    "Season int, OfficialDate date, DayNight string, Time string, AMPM string, "
    "AwayTeamID bigint, AwayTeamName string, AwayLeagueName string, AwayTeamShortName string, "
    "AwayProbPitcherID bigint, AwayProbPitcherFullName string, AwayWins int, AwayLosses int, "
    "AwayWinningPercentage double, "
    "HomeTeamID bigint, HomeTeamName string, HomeLeagueName string, HomeTeamShortName string, "
    "HomeProbPitcherID bigint, HomeProbPitcherFullName string, HomeWins int, HomeLosses int, "
    "HomeWinningPercentage double, DetailedState string, HomeRuns int, AwayRuns int"
)
_GAME_COLUMNS = (
    "gamepk bigint, id string, gamenumber int, season int, officialdate date, daynight string, time string, "
    "ampm string, detailedstate string"
)


def _ints(names: tuple[str, ...]) -> str:
    return ", ".join(f"{n} int" for n in names)


_TEAM_COLUMNS = "team_id bigint, team_name string"
_PLAYER_COLUMNS = "player_id bigint, player_name string, team_type string, team_name string"
TEAM_BATTING = f"{_ints(BATTING_STATS)}, {_TEAM_COLUMNS}, {_GAME_COLUMNS}"
TEAM_PITCHING = f"{_ints(PITCHING_STATS)}, {_TEAM_COLUMNS}, {_GAME_COLUMNS}"
INDIVIDUAL_BATTING = f"{_ints(BATTING_STATS)}, {_PLAYER_COLUMNS}, {_GAME_COLUMNS}"
INDIVIDUAL_PITCHING = f"{_ints(PITCHING_STATS)}, {_PLAYER_COLUMNS}, {_GAME_COLUMNS}"

TABLES = {
    "games_history": GAMES,
    "team_batting": TEAM_BATTING,
    "team_pitching": TEAM_PITCHING,
    "individual_batting": INDIVIDUAL_BATTING,
    "individual_pitching": INDIVIDUAL_PITCHING,
    "scheduled": GAMES,
}

ODDS_ROWS = (
    "sport_key string, sport_title string, away_team string, home_team string, id string, commence_time string, "
    "bookmaker_title string, bookmaker_key string, bookmaker_last_update string, market_key string, "
    "market_last_update string, outcome_name string, outcome_price double"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
