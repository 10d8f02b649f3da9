"""Trailing averages and as-of form against hand-computed and brute-force answers."""

import datetime as dt
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import form
from formline.operators.form import FormSpec

SPEC = FormSpec(entity=("team",), measures=("runs", "avg"), windows=(1, 3), ratios=frozenset({"avg"}))
SCHEMA = "team string, season int, officialdate date, id int, runs int, avg double"


def day(n, year=2024):
    return dt.date(year, 4, 1) + dt.timedelta(days=n)


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def random_rows(n=400, seed=3):
    """Hot team, doubleheaders, several rows per id, NULL measures, two seasons."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        team = "hot" if i % 3 == 0 else draw.choice("abc")
        year = draw.choice([2023, 2024])
        when = day(0 if i % 9 == 0 else draw.randrange(25), year)
        runs = None if draw.random() < 0.1 else draw.randrange(9)
        rows.append((team, year, when, draw.randrange(60), runs, None if runs is None else runs / 7))
    return rows


def ordered(rows):
    """Newest first, as the specification orders rows."""
    low = float("-inf")
    return sorted(rows, key=lambda r: (r[2], r[3], low if r[4] is None else r[4], low if r[5] is None else r[5]), reverse=True)


def mean(values, digits=None):
    values = [v for v in values if v is not None]
    if not values:
        return None
    out = sum(values) / len(values)
    return out if digits is None else round(out, digits)


def averages(newest_first):
    out = []
    for n in SPEC.windows:
        head = newest_first[:n]
        out += [mean([r[4] for r in head]), mean([r[5] for r in head], 9)]
    return tuple(out)


def brute_trailing(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[1]), []).append(r)
    out = []
    for mine in groups.values():
        mine = ordered(mine)
        out += [(*r, *averages(mine[i:])) for i, r in enumerate(mine)]
    return out


def rounded(df):
    keep = ["team", "season", "officialdate", "id", "runs", "avg"]
    return df.select(*[c for c in keep if c in df.columns], "runs_last_1", F.round("avg_last_1", 9), "runs_last_3", F.round("avg_last_3", 9))


@pytest.mark.parametrize("limit", [10, 25, 100_000])
def test_trailing_rows_equal_brute_force_with_and_without_blocks(spark, limit):
    rows = random_rows()
    got = form.trailing_rows(make(spark, rows), SPEC, limit=limit)
    assert rows_of(rounded(got), rounded(got).columns) == sorted(brute_trailing(rows), key=repr)


def test_short_history_and_counts(spark):
    df = make(spark, [("a", 2024, day(0), 1, 4, 0.5), ("a", 2024, day(1), 2, 2, None)])
    got = {r.id: r for r in form.trailing_rows(df, SPEC, counts=True).collect()}
    assert (got[1].runs_last_3, got[1].games_last_3) == (4.0, 1)
    assert (got[2].runs_last_3, got[2].avg_last_3, got[2].games_last_3) == (3.0, 0.5, 2)
    assert got[2].avg_last_1 is None


def test_snapshots_have_one_row_per_day_played(spark):
    rows = random_rows()
    snaps = form.snapshots(make(spark, rows), SPEC)
    expected = []
    for team, season, when in {r[:3] for r in rows}:
        mine = ordered([r for r in rows if r[0] == team and r[1] == season and r[2] <= when])
        expected.append((team, season, when, mine[0][3], *averages(mine)))
    got = rounded(snaps)
    assert rows_of(got, got.columns) == sorted(expected, key=repr)


def as_of_loop(rows, team, season, when):
    """The per-date way: rows before the date, newest first."""
    mine = ordered([r for r in rows if r[0] == team and r[1] == season and r[2] < when])
    return (mine[0][2], mine[0][3], *averages(mine)) if mine else None


def test_as_of_equals_a_loop_over_dates_and_never_looks_ahead(spark):
    rows = random_rows()
    asks = [(t, y, day(n, y)) for t in ("hot", "a", "b", "nobody") for y in (2023, 2024) for n in range(0, 28, 3)]
    wanted = spark.createDataFrame(asks + asks, "team string, season int, as_of date")
    found = form.last_before(wanted, form.snapshots(make(spark, rows), SPEC), SPEC)
    got = {(r.team, r.season, r.as_of): r for r in found.collect()}
    assert len(got) == found.count()
    for ask in asks:
        expected = as_of_loop(rows, *ask)
        if expected is None:
            assert ask not in got
            continue
        r = got[ask]
        assert r.officialdate < ask[2]
        assert (r.officialdate, r.id, r.runs_last_1, round(r.avg_last_1, 9) if r.avg_last_1 is not None else None) == expected[:4]


def test_second_game_of_a_day_does_not_see_the_first(spark):
    df = make(spark, [("a", 2024, day(0), 1, 1, None), ("a", 2024, day(1), 2, 9, None), ("a", 2024, day(1), 3, 5, None)])
    wanted = spark.createDataFrame([("a", 2024, day(1)), ("a", 2024, day(2))], "team string, season int, as_of date")
    got = {r.as_of: r for r in form.last_before(wanted, form.snapshots(df, SPEC), SPEC).collect()}
    assert got[day(1)].runs_last_3 == 1.0
    assert (got[day(2)].id, got[day(2)].runs_last_1, got[day(2)].runs_last_3) == (3, 5.0, 5.0)


def test_grid_equals_the_loop_for_every_team_and_date(spark):
    rows = random_rows()
    dates = [(y, day(n, y)) for y in (2023, 2024) for n in range(0, 30, 4)]
    as_of = spark.createDataFrame(dates, "season int, as_of date")
    grid = form.as_of_grid(form.snapshots(make(spark, rows), SPEC), as_of, SPEC)
    got = sorted((r.team, r.season, r.as_of, r.officialdate, r.id) for r in grid.collect())
    expected = []
    for team in "hot", "a", "b", "c":
        for season, when in dates:
            answer = as_of_loop(rows, team, season, when)
            if answer:
                expected.append((team, season, when, *answer[:2]))
    assert got == sorted(expected)


@pytest.mark.parametrize("bounded", [True, False])
def test_league_ranks_with_ties(spark, bounded):
    rows = [(t, 2024, day(0), i, runs, None) for i, (t, runs) in enumerate([("a", 5), ("b", 7), ("c", 5), ("d", None)])]
    as_of = spark.createDataFrame([(2024, day(1)), (2024, day(2))], "season int, as_of date")
    grid = form.as_of_grid(form.snapshots(make(spark, rows), SPEC), as_of, SPEC)
    ranked = form.league_ranks(grid, SPEC, bounded)
    got = {(r.team, r.as_of): r.rank_runs_last_3 for r in ranked.collect()}
    for when in day(1), day(2):
        assert [got[t, when] for t in "abcd"] == [2, 1, 2, 4]


def test_ranked_form_is_the_same_when_groups_are_oversized(spark, tiny_groups):
    rows = [(f"t{i}", 2024, day(i % 5), i, i * 7 % 11, i / 50) for i in range(60)]
    as_of = spark.createDataFrame([(2024, day(n)) for n in (2, 4, 6)], "season int, as_of date")
    df = make(spark, rows)
    assert not form.entities_fit_window(df, SPEC)
    split = rows_of(form.ranked_form(df, as_of, SPEC))
    assert split == rows_of(form.ranked_form(df, as_of, SPEC, league=1, days=3))


def test_latest_rows_with_one_and_all_ties(spark):
    df = make(spark, [("a", 2024, day(1), 1, 3, None), ("a", 2024, day(1), 2, 4, None), ("a", 2024, day(0), 9, 5, None)])
    one = form.latest_rows(df, ["team", "season"], ["officialdate", "id"])
    assert [r.id for r in one.collect()] == [2]
    everyone = form.latest_rows(df, ["team", "season"], ["officialdate"], ties="all")
    assert sorted(r.id for r in everyone.collect()) == [1, 2]


def test_ties_return_all_rows_of_the_answering_date(spark):
    df = make(spark, [("a", 2024, day(1), 1, 3, None), ("a", 2024, day(1), 2, 4, None), ("a", 2024, day(0), 9, 5, None)])
    wanted = spark.createDataFrame([("a", 2024, day(3))], "team string, season int, as_of date")
    found = form.last_before(wanted, form.snapshots(df, SPEC), SPEC)
    got = form.with_ties(found, form.trailing_rows(df, SPEC), SPEC)
    assert sorted((r.id, r.runs_last_3) for r in got.collect()) == [(1, 4.0), (2, 4.0)]


def test_zero_at_bats_and_copies(spark):
    schema = (
        "team_name string, season int, officialdate date, id int, runs int, hits int, atbats int, strikeouts int, "
        "baseonballs int, intentionalwalks int"
    )
    rows = [("a", 2024, day(0), 1, 2, 3, 0, 4, 5, 1)] * 3 + [("a", 2024, day(0), 2, 2, 3, 12, 4, 5, 1)]
    got = {r.id: r for r in form.team_measures(spark.createDataFrame(rows, schema)).collect()}
    assert len(got) == 2 and got[1].batting_avg is None and got[2].batting_avg == 0.25 and got[1].walks == 6


def test_record_before_game_leaves_out_the_day_itself(spark):
    schema = (
        "GamePK int, Season int, OfficialDate date, HomeTeamName string, AwayTeamName string, HomeRuns int, AwayRuns int, "
        "DetailedState string"
    )
    games = spark.createDataFrame([
        (1, 2024, day(0), "a", "b", 3, 1, "Final"), (2, 2024, day(1), "b", "a", 2, 2, "Final"),
        (3, 2024, day(2), "a", "b", 0, 4, "Final"), (4, 2024, day(2), "a", "b", 9, 4, "Postponed"),
        (5, 2024, day(3), "a", "c", None, None, "Scheduled"),
    ], schema)
    got = {r.GamePK: (r.HomeWinsBefore, r.HomeLossesBefore, r.AwayWinsBefore, r.AwayLossesBefore)
           for r in form.record_before_game(games).collect()}
    assert got == {1: (0, 0, 0, 0), 2: (0, 1, 1, 0), 3: (1, 0, 0, 1), 4: (1, 0, 0, 1), 5: (1, 1, 0, 0)}
