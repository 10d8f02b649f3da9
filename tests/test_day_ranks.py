"""Ranks of many entities, looked up by value and date before the grid is laid out."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_short_seasons import SPEC, pitching, wanted  # noqa: F401

from formline.operators import form, matchup


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def as_of(wanted):  # noqa: F811
    return wanted.select("season", "as_of")


@pytest.mark.parametrize("counts", [False, True])
def test_ranks_of_many_are_those_of_the_windows(pitching, as_of, counts):  # noqa: F811
    """The grid was shuffled by date and sorted once per metric before; now neither."""
    whole = form.ranked_form(pitching, as_of, SPEC, counts)
    found = form.ranked_form(pitching, as_of, SPEC, counts, league=12, many=True)
    assert found.dtypes == whole.dtypes and found.count() > 200
    assert rows_of(found) == rows_of(whole)
    assert "Window [rank(" in plan_of(whole) and "Window [rank(" not in plan_of(found)


def test_ranks_of_many_values_keep_the_windows(pitching, as_of, monkeypatch):  # noqa: F811
    expected = rows_of(form.ranked_form(pitching, as_of, SPEC, many=True))
    monkeypatch.setattr(form, "BROADCAST_RANKS", 100)
    found = form.ranked_form(pitching, as_of, SPEC, many=True)
    assert "Window [rank(" in plan_of(found) and rows_of(found) == expected


def test_starters_look_their_ranks_up(pitching, wanted, monkeypatch):  # noqa: F811
    """Before, the starters of a date and its values were sorted together once per metric, in one task."""
    games = wanted.select(
        F.col("player_name").alias("HomeProbPitcherFullName"), F.lit("p3").alias("AwayProbPitcherFullName"),
        F.col("season").alias("Season"), F.col("as_of").alias("OfficialDate"),
    )
    found = matchup.pitcher_form_for(games, pitching, pitchers=12)
    assert plan_of(found).count("Window [") == 1 and found.count() > 80
    monkeypatch.setattr(form, "BROADCAST_RANKS", 100)
    sorted_ = matchup.pitcher_form_for(games, pitching, pitchers=12)
    assert plan_of(sorted_).count("Window [") > 6
    assert found.dtypes == sorted_.dtypes and rows_of(found) == rows_of(sorted_)
