"""Form of wanted dates from one sequence of rows and dates, and copies found by a hash of the row."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import datasets, form, matchup, model

SPEC = form.PITCHER_FORM
START = dt.date(2020, 5, 1)


@pytest.fixture(scope="module")
def pitching(spark):
    """Several rows on a date, copies of rows, and missing measures, dates, ids, seasons and names."""
    draw, rows = random.Random(7), []
    for i in range(500):
        day = None if i % 41 == 0 else START + dt.timedelta(draw.randrange(25) + 366 * (i % 2))
        name = None if i % 53 == 0 else f"p{draw.randrange(12)}"
        season = None if i % 67 == 0 else 2020 + i % 2
        runs = None if draw.random() < 0.2 else draw.randrange(5)
        rows.append((name, season, day, None if i % 31 == 0 else i % 200, f"t{i % 3}", draw.randrange(9), runs))
    return spark.createDataFrame(
        rows + rows[:60], "player_name string, season int, officialdate date, id int, team_name string, strikeouts int, runs int"
    )


@pytest.fixture(scope="module")
def wanted(spark):
    draw = random.Random(8)
    rows = [(f"p{draw.randrange(14)}", 2020 + i % 2, START + dt.timedelta(draw.randrange(30) + 366 * (i % 2))) for i in range(150)]
    rows += [(None, 2020, START + dt.timedelta(20)), ("p1", None, START + dt.timedelta(20)), ("p1", 2020, None)]
    return spark.createDataFrame(rows, "player_name string, season int, as_of date")


SPECS = [SPEC, replace(SPEC, ratios=frozenset({"runs"})), replace(SPEC, carry=("team_name", "runs"), windows=(2,))]


@pytest.mark.parametrize("spec", SPECS)
def test_form_from_one_sequence_is_that_of_the_snapshots(pitching, wanted, spec):
    looked_up = form.last_before(wanted, form.snapshots(pitching, spec), spec)
    found = form.form_before(wanted, pitching, spec)
    assert found.dtypes == looked_up.dtypes and found.count() > 80
    assert rows_of(found) == rows_of(looked_up)


@pytest.mark.parametrize("counts", [False, True])
def test_snapshots_of_short_seasons_are_those_of_all(pitching, counts):
    whole, short = (form.snapshots(pitching, SPEC, counts, short) for short in (False, True))
    assert short.dtypes == whole.dtypes and rows_of(short) == rows_of(whole)


def exchanges_of_rows(df):
    """Shuffles in the plan, without those that only make the wanted dates distinct."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(player_name")


def test_starters_are_shuffled_once_where_seasons_are_short(pitching, wanted, monkeypatch):
    """Before, rows were shuffled by date and by season for their snapshots, and these again to be looked up."""
    games = wanted.select(
        F.col("player_name").alias("HomeProbPitcherFullName"), F.lit("p3").alias("AwayProbPitcherFullName"),
        F.col("season").alias("Season"), F.col("as_of").alias("OfficialDate"),
    )
    found = matchup.pitcher_form_for(games, pitching, ranks=False)
    assert "WindowGroupLimit" not in found._jdf.queryExecution().executedPlan().toString()
    few = exchanges_of_rows(found)
    monkeypatch.setattr(form, "SHORT_SEASON", 3)
    long = matchup.pitcher_form_for(games, pitching, ranks=False)
    assert exchanges_of_rows(long) == few + 2 and rows_of(long) == rows_of(found)


def test_copies_are_found_without_a_shuffle_of_whole_rows(spark):
    draw = random.Random(3)
    rows = [(i, 2021 + i % 5, draw.random() if i % 9 else None, draw.randrange(4) / 2, i % 2) for i in range(300)]
    rows += rows[:50] + [(1, 2022, -0.0, 0.5, 1), (1, 2022, 0.0, 0.5, 1), (1, 2022, float("nan"), 0.5, 1)] + rows[:50]
    table = spark.createDataFrame(rows, "GamePK int, season int, signal double, noise double, HomeTeamWin int")
    table = datasets.season_split(table, 2023, 2024)
    fitted = model.train_classifier(
        table.where("dataset = 'train' and not isnan(signal)"), ["signal", "noise"], params=model.TreeParams(depth=2, rounds=3)
    )
    whole = model.score(fitted, table.where("dataset is not null")).where("model_prediction is not null").dropDuplicates()
    found = model.score_splits(fitted, table)
    plus = lambda df: rows_of(df.withColumn("signal", F.col("signal") + 0.0))
    assert found.columns == whole.columns and plus(found) == plus(whole)
    once = model.score_splits(fitted, table.where("GamePK > 60"))
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString() and once.count() > 100
