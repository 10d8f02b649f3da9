"""Ranks of the pitchers asked for, without a row per pitcher and date."""

import datetime as dt
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import form, matchup

SPEC = form.PITCHER_FORM
START = dt.date(2020, 5, 1)


@pytest.fixture(scope="module")
def pitching(spark):
    """Pitchers with few distinct values, so many ranks tie; some measures, seasons, dates and names are missing."""
    draw, rows = random.Random(4), []
    for i in range(600):
        day = None if i % 97 == 0 else START + dt.timedelta(draw.randrange(40) + 366 * (i % 2))
        name = None if i % 53 == 0 else f"p{draw.randrange(25)}"
        runs = None if draw.random() < 0.2 else draw.randrange(3)
        season = None if i % 101 == 0 else 2020 + i % 2
        rows.append((name, season, day, i, "t", draw.randrange(2) if i % 7 else None, runs))
    rows += rows[:40]
    return spark.createDataFrame(
        rows, "player_name string, season int, officialdate date, id int, team_name string, strikeouts int, runs int"
    )


@pytest.fixture(scope="module")
def games(spark):
    draw = random.Random(5)
    rows = [
        (f"p{draw.randrange(30)}", None if i % 29 == 0 else f"p{draw.randrange(30)}", 2020 + i % 2, START + dt.timedelta(draw.randrange(45) + 366 * (i % 2)))
        for i in range(80)
    ]
    return spark.createDataFrame(rows, "HomeProbPitcherFullName string, AwayProbPitcherFullName string, Season int, OfficialDate date")


def test_wanted_ranks_are_those_among_all_pitchers(spark, pitching, games):
    as_of, wanted = matchup.as_of_dates(games, SPEC), matchup.wanted_dates(games, SPEC)
    whole = form.ranked_form(pitching, as_of, SPEC)
    asked = [F.col(f"a.{k}").eqNullSafe(F.col(f"w.{k}")) for k in [*SPEC.keys, form.AS_OF]]
    expected = whole.alias("a").join(wanted.alias("w"), asked, "left_semi")
    found = form.ranked_wanted(pitching, wanted, as_of, SPEC)
    assert found.columns == whole.columns and found.count() > 80
    assert rows_of(found) == rows_of(expected)
    assert found.dtypes == whole.dtypes
    assert rows_of(form.ranked_wanted(pitching, wanted, as_of, SPEC, derived=True)) == rows_of(expected)


def test_pitchers_that_no_game_asks_for_have_no_rows(spark, pitching, games):
    """Their values count in the ranks; their rows met the games in two joins before."""
    found = matchup.pitcher_form_for(games.limit(3), pitching, pitchers=25, days=3)
    wanted = matchup.wanted_dates(games.limit(3), SPEC)
    assert 0 < found.count() <= wanted.count()


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_starters_join_while_the_rows_are_narrow(spark, pitching, games):
    """The teams' form, which is wide, isn't carried through the joins of the starters; the columns keep their order."""
    batting = spark.createDataFrame(
        [("x", 2020, START, 1, 3, 1, 2, 1)],
        "team_name string, season int, officialdate date, id int, runs int, hits int, atbats int, baseonballs int",
    ).withColumns({"strikeouts": F.lit(4), "intentionalwalks": F.lit(0)})
    played = games.withColumns({"HomeTeamName": F.lit("x"), "AwayTeamName": F.lit("y")})
    starts = pitching.withColumn("detailedstate", F.lit("Final"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = matchup.assemble_matchup(played, batting, starts)
    first = [out.columns.index(c) for c in ("home_team_name", "away_team_name", "home_sp_player_name", "away_sp_player_name")]
    assert first == sorted(first) and out.columns[: len(played.columns)] == played.columns
    logical = out._jdf.queryExecution().analyzed().toString()
    assert logical.index("home_team_name") < logical.index("home_sp_player_name")
    joins = [line for line in logical.splitlines() if "Join LeftOuter" in line]
    assert [("sp_" in j) for j in joins[:4]] == [False, False, True, True]
    few = matchup.assemble_matchup(played, batting, starts, league=1, days=90)
    sent = [sum("BroadcastHashJoin" in x and "LeftOuter" in x for x in plan_of(df).splitlines()) for df in (out, few)]
    assert sent == [0, 2] and rows_of(few) == rows_of(out)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
