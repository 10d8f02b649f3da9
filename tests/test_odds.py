import datetime as dt
import json

import pytest
from conftest import rows_of
from documents import odds_event
from pyspark.sql import functions as F

from formline.functions import zones
from formline.operators import odds
from formline.plans import jobs

BOOKS = ["betmgm", "fanduel"]
EVENTS = [
    # two snapshots of one event: the earlier price counts
    odds_event("e1", "New York Mets", "Houston Astros", "2024-08-17T02:10:00Z", [
        ("betmgm", "2024-08-16T09:00:00Z", {"New York Mets": -120.0, "Houston Astros": 110.0}),
        ("fanduel", "2024-08-16T09:05:00Z", {"New York Mets": -125.0, "Houston Astros": 105.0}),
        ("bovada", "2024-08-16T09:05:00Z", {"New York Mets": 1.0, "Houston Astros": 1.0}),
    ]),
    odds_event("e1", "New York Mets", "Houston Astros", "2024-08-17T02:10:00Z", [
        ("betmgm", "2024-08-15T09:00:00Z", {"New York Mets": -100.0, "Houston Astros": 100.0}),
    ]),
    # a doubleheader: same home team, same Eastern date
    odds_event("e2", "New York Mets", "Houston Astros", "2024-08-16T17:05:00Z", [
        ("betmgm", "2024-08-16T09:00:00Z", {"New York Mets": -150.0, "Houston Astros": 140.0}),
    ]),
    # no zone known, priced on one side only at one book
    odds_event("e3", "Harbor", "Canyon", "2024-08-16T20:00:00Z", [
        ("fanduel", "2024-08-16T09:00:00Z", {"Harbor": -130.0, "Canyon": None}),
        ("betmgm", "2024-08-16T09:00:00Z", {"Harbor": None, "Canyon": 125.0}),
    ]),
    odds_event("e4", "Harbor", "Canyon", "2024-08-18T20:00:00Z", []),
    odds_event("e5", "Harbor", "Canyon", "2024-08-19T20:00:00Z", [("betmgm", "2024-08-16T09:00:00Z", None)]),
    odds_event("e6", "Harbor", "Canyon", "2024-08-20T20:00:00Z", [("betmgm", "2024-08-16T09:00:00Z", {"Harbor": -110.0})]),
]


@pytest.fixture
def snapshots(tmp_path):
    lines = [json.dumps({"data": EVENTS[:1]}), json.dumps({"data": []}), json.dumps({"data": EVENTS[1:]}), json.dumps({})]
    (tmp_path / "odds.json").write_text("\n".join(lines))
    return str(tmp_path)


@pytest.fixture
def rows(spark, snapshots):
    return odds.unpivot_bookmakers(odds.parse_odds_event(odds_scan(spark, snapshots)))


def odds_scan(spark, path):
    from formline.sources.documents import scan_odds_json

    return scan_odds_json(spark, path)


def test_rows_are_as_many_as_outcomes(spark, snapshots, rows):
    assert odds_scan(spark, snapshots).count() == len(EVENTS)
    outcomes = sum(len(m["outcomes"]) for e in EVENTS for b in e["bookmakers"] for m in b["markets"])
    assert rows.count() == outcomes and len(rows.columns) == 13
    assert {r.id for r in rows.select("id").collect()} == {"e1", "e2", "e3", "e6"}


def test_event_text_that_cannot_be_read_gives_nulls(spark):
    df = spark.createDataFrame([(json.dumps(EVENTS[0]),), ("{broken",), (None,), ('{"id": "x"}',)], "data string")
    got = odds.parse_odds_event(df).select("id", F.size("bookmakers").alias("n")).collect()
    assert sorted((r.id or "", r.n) for r in got) == [("", 0), ("", 0), ("e1", 3), ("x", 0)]


def test_first_price_by_book(rows):
    got = {(r.id, r.outcome_name): (r.betmgm, r.fanduel) for r in odds.pivot_odds_by_book(rows, BOOKS).collect()}
    assert got == {
        ("e1", "New York Mets"): (-100.0, -125.0), ("e1", "Houston Astros"): (100.0, 105.0),
        ("e2", "New York Mets"): (-150.0, None), ("e2", "Houston Astros"): (140.0, None),
        ("e3", "Harbor"): (None, -130.0), ("e3", "Canyon"): (125.0, None), ("e6", "Harbor"): (-110.0, None),
    }


def test_merging_sides_equals_joining_the_pivot(rows):
    pivot = odds.pivot_odds_by_book(rows, BOOKS)
    away, home = odds.side_filter(pivot, "away"), odds.side_filter(pivot, "home")
    for side, name in ((away, "away"), (home, "home")):
        names = {c: f"{c}_{name}" for c in ("outcome_name", *BOOKS)}
        if name == "away":
            joined = side.withColumnsRenamed(names)
        else:
            joined = joined.join(side.withColumnsRenamed(names), odds.EVENT_KEYS)
    merged = odds.merge_home_away_odds(rows, BOOKS)
    assert merged.columns == joined.columns and rows_of(merged) == rows_of(joined)
    assert {r.id for r in merged.collect()} == {"e1", "e2", "e3"}


def test_local_times_and_game_numbers(spark, snapshots):
    got = {r.id: r for r in jobs.format_odds(spark, snapshots).select(
        "id", "gameNumber", "officialDate", F.date_format("local_commence_time", "dd HH:mm").alias("local"),
        F.date_format("eastern_commence_time", "dd HH:mm").alias("eastern"),
    ).collect()}
    # 02:10 UTC is still the evening before in the East
    assert (got["e1"].eastern, got["e1"].local, got["e1"].officialDate, got["e1"].gameNumber) == (
        "16 22:10", "16 22:10", dt.date(2024, 8, 16), 2
    )
    assert (got["e2"].eastern, got["e2"].gameNumber) == ("16 13:05", 1)
    assert (got["e3"].local, got["e3"].eastern, got["e3"].gameNumber) == ("16 20:00", "16 16:00", 1)


def test_game_numbers_in_oversized_days(spark, tiny_groups):
    rows = [("a" if i % 3 else "b", dt.datetime(2024, 5, 1 + i % 2, 12, i * 7 % 60)) for i in range(200)]
    df = spark.createDataFrame(rows, "home_team string, eastern_commence_time timestamp")
    got = odds.daily_game_number(df)
    plain = odds.daily_game_number(df, limit=10_000)
    assert rows_of(got) == rows_of(plain)


def test_zone_table_and_default(spark):
    df = spark.createDataFrame([("Colorado Rockies",), ("Nobody",), (None,)], "home_team string")
    got = zones.dim_lookup(df, zones.zone_table(spark), "home_team", "team", "tz", "UTC")
    assert {r.home_team: r.tz for r in got.collect()} == {"Colorado Rockies": "America/Denver", "Nobody": "UTC", None: "UTC"}
    assert len(zones.TEAM_ZONES) == 29


def test_no_events_give_an_empty_result(spark, tmp_path):
    (tmp_path / "none.json").write_text('{"data": []}\n')
    assert jobs.format_odds(spark, str(tmp_path)).count() == 0


def test_a_small_dimension_is_broadcast_by_the_plan_itself(spark):
    from formline.functions import zones

    fact = spark.range(1000).selectExpr("id", "concat('Team ', id) AS home_team")
    found = zones.dim_lookup(fact, zones.zone_table(spark), "home_team", "team", "tz", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ExistingRDD" not in plan
    assert zones.zone_table(spark, {}).count() == 0 and zones.zone_table(spark, {"O'Hara \\ \"x\"": "UTC"}).first().team == "O'Hara \\ \"x\""


def test_a_repeated_key_of_a_dimension_is_an_error(spark):
    import pytest

    from formline.functions import zones

    dim = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), (None, "n"), (None, "m")], "team string, tz string")
    fact = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "t string")
    single = zones.dim_lookup(fact, dim.where("tz <> 'y'"), "t", "team", "tz", "UTC")
    assert sorted(tuple(r) for r in single.fillna("-").collect()) == [("-", "UTC"), ("a", "x"), ("b", "z"), ("c", "UTC")]
    with pytest.raises(Exception, match="repeated key in team: a"):
        zones.dim_lookup(fact, dim, "t", "team", "tz", "UTC").collect()
