import json
import random

import pytest
from conftest import rows_of
from documents import season
from pyspark.sql import functions as F

from formline.operators import columns, flatten
from formline.plans import jobs
from formline.schemas import GAME_DOCUMENT, GAMES, TEAM_BATTING, struct
from formline.sources import csv as csv_source
from formline.sources import documents, tables


def write_lines(folder, docs, extra=()):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(d) for d in docs]
    (folder / "part-0.json").write_text("\n".join([*lines[:3], *extra, *lines[3:]]) + "\n")
    return str(folder)


@pytest.fixture(scope="module")
def games():
    return season(2024, 12, 5, 100)


@pytest.fixture(scope="module")
def docs(spark, games, tmp_path_factory):
    return documents.scan_game_json(spark, write_lines(tmp_path_factory.mktemp("docs"), games))


def test_games_have_all_columns_and_the_sentinel_for_unknown_pitchers(docs, games):
    flat = flatten.flatten_games(docs)
    assert flat.columns == struct(GAMES).names and flat.count() == len(games)
    assert [t for _, t in flat.dtypes] == [f.dataType.simpleString() for f in struct(GAMES)]
    by_pk = {r.GamePK: r for r in flat.collect()}
    for g in games:
        r, data = by_pk[g["gamepk"]], g["gamedata"]
        away = data["probablepitchers"]["away"] or {"id": -999, "fullname": "unannounced"}
        assert (r.AwayProbPitcherID, r.AwayProbPitcherFullName) == (away["id"], away["fullname"])
        assert r.HomeWins == data["teams"]["home"]["record"]["wins"]
        assert r.HomeRuns == g["livedata"]["boxscore"]["teams"]["home"]["teamstats"]["batting"]["runs"]
        assert str(r.OfficialDate) == data["datetime"]["officialdate"]


def test_team_rows_are_two_per_game(docs, games):
    flat = flatten.flatten_team_stats(docs, "batting")
    assert flat.columns == struct(TEAM_BATTING).names and flat.count() == 2 * len(games)
    extra = flatten.flatten_team_stats(docs, "batting", extra=True).where("detailedstate = 'Final'").first()
    assert set(extra.stats_extra.toPython()) == {"homeruns"}


def test_player_rows_have_statistics_and_pitching_needs_the_position(docs, games):
    def expected(kind):
        out = []
        for g in games:
            for side in ("home", "away"):
                team = g["livedata"]["boxscore"]["teams"][side]
                for p in team["players"].values():
                    if p["stats"][kind] and (kind == "batting" or p["position"]["code"] == "1"):
                        out.append((g["gamepk"], p["person"]["id"], side, team["team"]["name"], p["stats"][kind]["runs"]))
        return sorted(out)

    for kind in ("batting", "pitching"):
        flat = flatten.flatten_player_stats(docs, kind)
        assert rows_of(flat, ["gamepk", "player_id", "team_type", "team_name", "runs"]) == sorted(expected(kind), key=repr)


def test_unreadable_lines_are_set_aside(spark, games, tmp_path):
    bad = ['{"gamepk": 1, "gamedata": ', "not json at all"]
    path = write_lines(tmp_path / "mixed", games, bad)
    assert documents.scan_game_json(spark, path).count() == len(games)
    assert rows_of(documents.bad_record_quarantine(spark, path)) == sorted([(b,) for b in bad], key=repr)


def test_one_parse_gives_documents_rejects_and_counts(spark, games, tmp_path):
    bad = ['{"gamepk": 1, "gamedata": ', '{"gamepk": "x"}', "[1, 2]", "null and void"]
    path = write_lines(tmp_path / "mixed", games, [*bad, "", "   "])
    parsed = documents.parse_once(spark, path, GAME_DOCUMENT)
    assert parsed.counts == {"read": len(games), "rejected": len(bad)}
    assert sorted(r.record for r in parsed.rejects.collect()) == sorted(bad)
    assert all(r.file.endswith("part-0.json") for r in parsed.rejects.collect())
    assert rows_of(flatten.flatten_games(parsed.documents)) == rows_of(flatten.flatten_games(documents.scan_game_json(spark, path)))
    # Tables read columns of the stored parse: no text, one status, no parser.
    plan = flatten.flatten_games(parsed.documents)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan text" not in plan and "from_json" not in plan
    assert "PartitionFilters: [isnotnull(_status" in plan and "players" not in plan.split("ReadSchema")[1]


def test_parse_of_nothing_and_of_broken_lines_alone(spark, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.json").write_text("\n\n")
    parsed = documents.parse_once(spark, str(tmp_path / "none"), GAME_DOCUMENT)
    assert parsed.counts == {"read": 0, "rejected": 0} and parsed.documents.count() == parsed.rejects.count() == 0
    (tmp_path / "none" / "b.json").write_text("{oops\n")
    parsed = documents.parse_once(spark, str(tmp_path / "none"), GAME_DOCUMENT)
    assert parsed.documents.count() == 0 and parsed.rejects.count() == 1


def test_every_statistic_is_named_and_reaches_the_parquet_tables(spark, tmp_path):
    """Statistics of any name and form: numbers, text, one of a single player, one that has a table column's name."""
    games = season(2023, 3, 2, 10) + season(2024, 3, 2, 50)
    box = games[0]["livedata"]["boxscore"]["teams"]
    box["home"]["teamstats"]["pitching"] |= {"era": "3.71", "ID": 9}
    next(iter(box["away"]["players"].values()))["stats"]["batting"] |= {"note": 'he said "no", twice', "ops": 0.75}
    docs = documents.scan_game_json(spark, write_lines(tmp_path / "in", games))
    names = flatten.stat_names(docs)
    assert set(names["pitching"]) >= {"homeruns", "era", "ID"} and set(names["batting"]) >= {"homeruns", "note", "ops"}
    counts = jobs.flatten(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2023-01-01", "2024-12-31")
    assert counts == {"games_history": {"read": len(games), "rejected": 0}}
    jobs.snapshot(spark, str(tmp_path / "out"), str(tmp_path / "lake"))
    for table in csv_source.REST:
        kind, whole = table.split("_")[1], flatten.flatten_all(docs)[table]
        stored = tables.scan_parquet(spark, str(tmp_path / "lake" / table))
        assert set(stored.columns) == set(whole.columns) and stored.schema[flatten.EXTRA].dataType.simpleString() == "variant"
        typed = [c for c in whole.columns if c != flatten.EXTRA]
        runs = F.try_variant_get(flatten.EXTRA, F.lit("$.homeruns"), "int").alias("homeruns")
        assert rows_of(stored.select(*typed, runs)) == rows_of(whole.select(*typed, runs))
        rest = [r[0].toPython() for r in stored.where("stats_extra is not null").select(flatten.EXTRA).collect()]
        if table == "team_pitching":
            assert [(r["era"], r["stat_ID"]) for r in rest if "era" in r] == [("3.71", "9")]
        if table == "individual_batting":
            assert [(r["note"], r["ops"]) for r in rest if "note" in r] == [('he said "no", twice', "0.75")]
        assert kind in names


def test_more_names_than_a_vocabulary_has_are_an_error(spark, games, tmp_path, monkeypatch):
    monkeypatch.setattr(flatten, "MAX_NAMES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        flatten.stat_names(documents.scan_game_json(spark, write_lines(tmp_path / "in", games)))


def test_snapshots_are_stored_by_season_and_filters_reach_the_partitions(spark, tmp_path):
    games = season(2023, 3, 2, 10) + season(2024, 3, 2, 50)
    jobs.flatten(spark, write_lines(tmp_path / "in", games), str(tmp_path / "out"), "2023-01-01", "2024-12-31")
    for _ in range(2):  # a second run replaces
        jobs.snapshot(spark, str(tmp_path / "out"), str(tmp_path / "lake"))
    assert sorted(p.name for p in (tmp_path / "lake" / "games_history").iterdir() if "=" in p.name) == ["Season=2023", "Season=2024"]
    rows = jobs.build_training_features(spark, str(tmp_path / "lake"), "2024-04-02", "2024-12-31")
    plan = rows._jdf.queryExecution().optimizedPlan().toString() + rows._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("PartitionFilters: [isnotnull(" in line and "2024" in line for line in scans)


def test_lines_a_job_cannot_read_are_kept_beside_its_tables(spark, games, tmp_path):
    path = write_lines(tmp_path / "in", games, ["{oops", "also not"])
    for _ in range(2):
        counts = jobs.flatten(spark, path, str(tmp_path / "out"), "2024-01-01", "2024-12-31", path, "2024-04-02")
    assert counts == {t: {"read": len(games), "rejected": 2} for t in ("games_history", "scheduled")}
    for table in ("games_history_20240101_20241231", "scheduled_20240402"):
        kept = tables.scan_parquet(spark, str(tmp_path / "out" / "rejects" / table))
        assert sorted(r.record for r in kept.collect()) == ["also not", "{oops"]


def test_csv_prefix_aligns_by_name_and_drops_index_columns(spark, tmp_path):
    (tmp_path / "x" / "deep").mkdir(parents=True)
    (tmp_path / "x" / "a.csv").write_text(",Unnamed: 0,b,a\n0,0,1,2\n")
    (tmp_path / "x" / "deep" / "b.csv").write_text("a,b,c\n3,4,\"five, six\"\n")
    (tmp_path / "x" / "deep" / "c.csv").write_text("A,b,c\n7,8,nine")
    (tmp_path / "x" / "deep" / "empty.csv").write_text("")
    (tmp_path / "x" / "note.txt").write_text("a,b\n9,9\n")
    got = csv_source.scan_csv_prefix(spark, str(tmp_path / "x"), "a int, b int, c string")
    assert rows_of(got, ["a", "b", "c"]) == [(2, 1, None), (3, 4, "five, six"), (7, 8, "nine")]
    whole = csv_source.scan_csv_prefix(spark, str(tmp_path / "x"), "a int, b int", rest="more")
    more = [(r.a, r.b, r.more.toPython() if r.more else None) for r in whole.collect()]
    assert sorted(more) == [(2, 1, None), (3, 4, {"c": "five, six"}), (7, 8, {"c": "nine"})]
    free = csv_source.scan_csv_prefix(spark, str(tmp_path / "x"))
    assert rows_of(free, ["a", "b"]) == [(2, 1), (3, 4), (7, 8)]


def test_csv_cells_of_another_type_go_to_the_rejects(spark, tmp_path):
    (tmp_path / "x y").mkdir()
    (tmp_path / "x y" / "a.csv").write_text("\ufeffid,n,day,note\n1,25.0,2024-01-02,id\n2,3.7,2024-01-03,\nid,n,day,note\n")
    (tmp_path / "x y" / "b.csv").write_text("\n \nday,more,more,ID\n2024-02-01,p,q,4\nnever,,,5\n2024-02-02,,,\n")
    path, kinds = str(tmp_path / "x y"), "id int, n int, day date"
    every = csv_source.scan_csv_prefix(spark, path, kinds, rest="rest")
    assert every.count() == 6 and every.where("id = 2 and n is null").count() == 1
    good = csv_source.scan_csv_prefix(spark, path, kinds, "rest", str(tmp_path / "rejects"))
    got = sorted((r.id or 0, r.n, str(r.day), r.rest.toPython() if r.rest else None) for r in good.collect())
    assert got == [(0, None, "2024-02-02", None), (1, 25, "2024-01-02", {"note": "id"}), (4, None, "2024-02-01", {"more": "p"})]
    bad = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert sorted((r.file[-5:], r.cells, r.unreadable) for r in bad) == [
        ("a.csv", ["2", "3.7", "2024-01-03", None], ["n"]), ("a.csv", ["id", "n", "day", "note"], ["id", "n", "day"]),
        ("b.csv", ["never", None, None, "5"], ["day"]),
    ]
    assert {tuple(r.columns) for r in bad} == {("day", "more", "more", "ID"), ("id", "n", "day", "note")}


def test_csv_types_are_the_narrowest_that_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("i,l,f,b,d,t,s,none\n1,1,1,true,2024-01-02,2024-01-02 03:04:05,x,\n2,9999999999,2.5,False,2024-1-3,2024-01-02T03:04:05Z,2024,\n")
    (tmp_path / "b.csv").write_text("s,i\n7,\n")
    got = csv_source.scan_csv_prefix(spark, str(tmp_path))
    assert dict(got.dtypes) == {"i": "int", "l": "bigint", "f": "double", "b": "boolean", "d": "date", "t": "timestamp", "s": "string", "none": "string"}
    assert got.count() == 3 and got.where("i is null and s = '7'").count() == 1


def test_csv_files_with_one_header_need_no_join_and_many_meet_in_a_shuffle(spark, tmp_path, monkeypatch):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.csv").write_text("a,b\n1,2\n")
    one = csv_source.scan_csv_prefix(spark, str(tmp_path), "b int, a int")
    assert rows_of(one, ["a", "b"]) == [(1, 2)] and "Join" not in one._jdf.queryExecution().executedPlan().toString()
    (tmp_path / "one" / "b.csv").write_text("b,a\n4,3\n")
    monkeypatch.setattr(csv_source, "BROADCAST_FILES", 1)
    assert rows_of(csv_source.scan_csv_prefix(spark, str(tmp_path), "b int, a int"), ["a", "b"]) == [(1, 2), (3, 4)]


def test_csv_prefix_without_files_is_empty(spark, tmp_path):
    got = csv_source.scan_csv_prefix(spark, str(tmp_path), "a int, b string")
    assert got.columns == ["a", "b"] and got.count() == 0


def test_year_category_tree_ignores_its_own_output(spark, docs, tmp_path):
    rows = flatten.flatten_team_stats(docs, "batting")
    pdf = rows.toPandas()
    for year, part in (("2023", pdf.iloc[:5]), ("2024", pdf.iloc[5:])):
        folder = tmp_path / year / "team_batting"
        folder.mkdir(parents=True)
        part.to_csv(folder / "part.csv")
    for _ in range(2):
        tree = csv_source.scan_year_category_tree(spark, str(tmp_path))
        assert rows_of(tree["team_batting"], rows.columns) == rows_of(rows, rows.columns)
        assert tree["mlb_games"].columns == struct(GAMES).names and tree["mlb_games"].count() == 0
        csv_source.combine_year_category_tree(spark, str(tmp_path))


def test_partitioned_overwrite_replaces_only_what_it_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, 2023), (2, 2024)], "a int, season int")
    tables.sink_parquet(base, path, partition_by=["season"])
    tables.sink_parquet(spark.createDataFrame([(9, 2024)], "a int, season int"), path, partition_by=["season"])
    assert rows_of(tables.scan_parquet(spark, path), ["a", "season"]) == [(1, 2023), (9, 2024)]


def test_period_files_are_replaced_by_a_second_run(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    for _ in range(2):
        path = tables.sink_csv_period(df, str(tmp_path), "games", "2024-08-07", "2024-08-09")
    tables.sink_csv_period(df, str(tmp_path), "games", "2024-08-10")
    assert path.endswith("games/games_20240807_20240809")
    assert csv_source.scan_csv_prefix(spark, str(tmp_path / "games"), "a int, b string").count() == 2


def test_observed_count_needs_no_second_pass(spark, tmp_path):
    df, seen = columns.observed(spark.range(25).withColumn("x", F.lit(1)), "passed")
    df.write.parquet(str(tmp_path / "o"))
    assert seen.get["row_count"] == 25


def test_projection_helpers(spark):
    df = spark.createDataFrame([(0, 0, 5, None), (1, 1, 6, 7)], "_c0 int, `Unnamed: 0` int, a int, b int")
    kept = columns.drop_index_columns(df)
    assert kept.columns == ["a", "b"]
    assert columns.prefix_columns("home_", kept).columns == ["home_a", "home_b"]
    once = columns.drop_null_rows(kept)
    assert rows_of(once) == rows_of(columns.drop_null_rows(once)) == [(6, 7)]
    counts = columns.row_counts({"x": kept, "y": once})
    assert rows_of(counts, ["table_name", "row_count"]) == [("x", 2), ("y", 1)]
