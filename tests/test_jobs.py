"""The pipeline from documents to scored games, checked against a plain loop over dates."""

import datetime as dt
import json
import random

import pytest
from conftest import rows_of
from documents import game, season
from pyspark.sql import functions as F

from formline.operators import datasets, model
from formline.operators.matchup import assemble_matchup
from formline.plans import jobs
from formline.schemas import TABLES
from formline.sources.csv import scan_csv_prefix
from formline.sources.tables import scan_parquet, sink_parquet

BEGIN, END, NEXT = "2022-04-01", "2024-05-10", "2024-05-11"


@pytest.fixture(scope="module")
def games():
    return [g for i, y in enumerate((2022, 2023, 2024)) for g in season(y, 40, 10 + i, 1000 * (i + 1))]


@pytest.fixture(scope="module")
def lake(spark, games, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    draw = random.Random(9)
    day = dt.date.fromisoformat(NEXT)
    upcoming = [game(draw, 9001, day, 0, 1, "Scheduled"), game(draw, 9002, day, 2, 3, "Scheduled")]
    for name, docs in (("played", games), ("upcoming", upcoming)):
        (root / name).mkdir()
        (root / name / "docs.json").write_text("\n".join(json.dumps(d) for d in docs))
    jobs.flatten(spark, str(root / "played"), str(root / "csv"), BEGIN, END, str(root / "upcoming"), NEXT)
    jobs.snapshot(spark, str(root / "csv"), str(root / "parquet"))
    sink_parquet(
        scan_csv_prefix(spark, str(root / "csv" / "scheduled"), TABLES["scheduled"]), str(root / "parquet" / "scheduled")
    )
    return root


@pytest.fixture(scope="module")
def features(spark, lake):
    path = str(lake / "features")
    jobs.build_training_features(spark, str(lake / "parquet"), BEGIN, END, path)
    return scan_parquet(spark, path)


def form_before(rows, name_column, name, year, when, measure, n):
    mine = sorted(
        (r for r in rows if r[name_column] == name and r["season"] == year and r["officialdate"] < when),
        key=lambda r: (r["officialdate"], r["id"]), reverse=True,
    )[:n]
    values = [measure(r) for r in mine if measure(r) is not None]
    return sum(values) / len(values) if values else None


def test_features_equal_a_loop_over_dates(spark, lake, features):
    batting = [r.asDict() for r in scan_parquet(spark, str(lake / "parquet" / "team_batting")).collect()]
    pitching = [
        r.asDict() for r in scan_parquet(spark, str(lake / "parquet" / "individual_pitching")).collect()
        if r.detailedstate == "Final"
    ]
    history = scan_parquet(spark, str(lake / "parquet" / "games_history")).where("DetailedState = 'Final'")
    assert features.count() == history.count()
    measures = {
        "runs": lambda r: r["runs"], "strikeouts": lambda r: r["strikeouts"],
        "batting_avg": lambda r: r["hits"] / r["atbats"] if r["atbats"] else None,
        "walks": lambda r: None if r["baseonballs"] is None else r["baseonballs"] + r["intentionalwalks"],
    }
    checked = 0
    for g in features.collect():
        for side in ("home", "away"):
            team = g[f"{side.capitalize()}TeamName"]
            pitcher = g[f"{side.capitalize()}ProbPitcherFullName"]
            for n in (1, 3, 7, 15):
                for m, measure in measures.items():
                    expected = form_before(batting, "team_name", team, g.Season, g.OfficialDate, measure, n)
                    got = g[f"{side}_{m}_last_{n}"]
                    assert got == (None if expected is None else pytest.approx(expected)), (g.GamePK, side, m, n)
                    if m != "batting_avg" and expected is not None:
                        league = [
                            form_before(batting, "team_name", t, g.Season, g.OfficialDate, measure, n)
                            for t in {r["team_name"] for r in batting}
                        ]
                        rank = 1 + sum(v is not None and v > expected + 1e-9 for v in league)
                        assert g[f"{side}_rank_{m}_last_{n}"] == rank
                        checked += 1
            for n in (1, 3, 7):
                expected = form_before(pitching, "player_name", pitcher, g.Season, g.OfficialDate, lambda r: r["runs"], n)
                assert g[f"{side}_sp_runs_last_{n}"] == (None if expected is None else pytest.approx(expected))
        last = g.home_officialdate
        assert last is None or last < g.OfficialDate
    assert checked > 1000


def test_a_shorter_range_gives_the_same_rows(spark, lake, features):
    part = jobs.build_training_features(spark, str(lake / "parquet"), "2023-04-20", "2023-04-30")
    same = features.where(F.col("OfficialDate").between(F.lit("2023-04-20"), F.lit("2023-04-30"))).select(part.columns)
    assert part.count() > 0 and rows_of(part) == rows_of(same)


def test_pitcher_ranks_count_all_pitchers_of_the_date(spark, lake, features):
    """The rank of a starter's average among the averages of all pitchers before the game's date."""
    from formline.operators import form

    tables = jobs.load_tables(spark, str(lake / "parquet"))
    snaps = form.snapshots(form.pitcher_measures(tables["individual_pitching"]), form.PITCHER_FORM).collect()
    checked = 0
    for g in features.where("OfficialDate between '2023-04-20' and '2023-04-23'").collect():
        newest = {}
        for s in sorted((s for s in snaps if s.season == g.Season and s.officialdate < g.OfficialDate), key=lambda s: s.officialdate):
            newest[s.player_name] = s
        if g.home_sp_player_name is not None:
            own = g.home_sp_strikeouts_last_7
            assert g.home_sp_rank_strikeouts_last_7 == 1 + sum(s.strikeouts_last_7 > own for s in newest.values())
            checked += 1
    assert checked > 0
    bare = jobs.training_features(tables, "2023-04-20", "2023-04-23", pitcher_ranks=False)
    assert {c for c in features.columns if "_sp_rank_" in c} == set(features.columns) - set(bare.columns)


def test_ids_and_pitcher_ranks_on_request(spark, lake):
    tables = jobs.load_tables(spark, str(lake / "parquet"))
    from formline.operators.form import PITCHER_FORM_BY_ID

    by_id = jobs.training_features(tables, "2023-04-20", "2023-04-25", pitcher_spec=PITCHER_FORM_BY_ID, pitcher_ranks=True)
    by_name = jobs.training_features(tables, "2023-04-20", "2023-04-25")
    shared = ["GamePK", "home_sp_runs_last_3", "away_sp_strikeouts_last_7"]
    assert rows_of(by_id, shared) == rows_of(by_name, shared)
    assert by_id.where("home_sp_rank_runs_last_7 = 1 or home_sp_rank_runs_last_7 > 1").count() > 0


def test_all_ties_fan_out(spark, lake):
    tables = jobs.load_tables(spark, str(lake / "parquet"))
    doubled = tables["individual_pitching"]
    extra = doubled.withColumn("id", F.concat("id", F.lit("b")))
    one = jobs.training_features({**tables, "individual_pitching": doubled.union(extra)}, "2023-04-20", "2023-04-25")
    fanned = jobs.training_features(
        {**tables, "individual_pitching": doubled.union(extra)}, "2023-04-20", "2023-04-25", pitcher_ties="all"
    )
    known = one.where("home_sp_player_name is not null and away_sp_player_name is not null").count()
    assert one.count() == one.select("GamePK").distinct().count()
    assert fanned.where("home_sp_player_name is not null and away_sp_player_name is not null").count() >= 4 * known > 0


@pytest.fixture(scope="module")
def model_tables(spark, lake, features):
    scheduled = str(lake / "scheduled_features")
    for hour in (6, 9):
        stamp = F.lit(f"{NEXT} 0{hour}:00:00").cast("timestamp")
        jobs.build_prediction_features(spark, str(lake / "parquet"), NEXT, scheduled, stamp=stamp)
    return jobs.assemble_modeling_datasets(spark, str(lake / "features"), scheduled, str(lake / "model_input"))


def test_model_tables(spark, features, model_tables):
    train, predict = (scan_parquet(spark, p) for p in model_tables)
    assert len(datasets.reporting_fields()) == len(set(datasets.reporting_fields())) == 105
    assert len(datasets.HOME_WIN_FEATURES) == 53 and train.columns == ["GamePK", "season", *datasets.HOME_WIN_FEATURES, "HomeTeamWin"]
    complete = features.na.drop(subset=datasets.reporting_fields())
    assert train.count() == complete.count() > 50
    assert complete.where("AwayProbPitcherId = -999").count() == 0
    assert predict.where("HomeTeamWin is not null").count() == 0
    assert predict.count() == predict.select("GamePK").distinct().count() <= 2
    wins = {r.GamePK: int(r.HomeRuns > r.AwayRuns) for r in complete.collect()}
    assert {r.GamePK: r.HomeTeamWin for r in train.select("GamePK", "HomeTeamWin").collect()} == wins


def test_runs_by_side_use_the_opposing_starter(features):
    away, home = datasets.dataset_runs_by_side(features)
    assert len(away.columns) == len(home.columns) == 2 + 29 + 1
    assert away.columns[-1] == "AwayRuns" and "home_sp_days_rest" in away.columns and "home_runs_last_1" not in away.columns
    assert home.columns[-1] == "HomeRuns" and "away_sp_days_rest" in home.columns and "away_runs_last_1" not in home.columns


def test_train_and_predict(spark, lake, model_tables):
    quick = model.TreeParams(depth=2, rounds=2)
    jobs.train_model(spark, model_tables[0], str(lake / "out"), "tag", validation=2023, test=2024, trials=1, base=quick)
    root = str(lake / "out" / "tag")
    scored = scan_parquet(spark, f"{root}/training_data_with_predictions")
    assert {r.dataset for r in scored.select("dataset").distinct().collect()} == {"train", "validation", "test"}
    assert {"model_prediction", "rounded", "pred_binary", "correct"} <= set(scored.columns)
    rolled = {r.dataset: r.pct for r in scan_parquet(spark, f"{root}/accuracy_55_test_result").collect()}
    for name, pct in rolled.items():
        assert pct == pytest.approx(scored.where(F.col("dataset") == name).agg(F.avg("correct")).first()[0])
    assert scan_parquet(spark, f"{root}/feature_importance").count() == 53
    games = jobs.predict(spark, model_tables[1], f"{root}/best_model", str(lake / "out"), "next")
    assert games.count() == scan_parquet(spark, model_tables[1]).count()
    assert scan_parquet(spark, str(lake / "out" / "next" / "game_predictions")).columns[-3:] == [
        "model_prediction", "rounded", "pred_home_win"
    ]


def test_command_line_passes_arguments(monkeypatch):
    from formline import __main__ as cli

    seen = {}

    class Stub:
        def stop(self):
            seen["stopped"] = True

    class Builder:
        def __getattr__(self, _):
            return lambda *a: self

        def getOrCreate(self):
            return Stub()

    monkeypatch.setattr(cli.SparkSession, "builder", Builder())
    monkeypatch.setitem(cli.JOBS, "train", (lambda spark, **kw: seen.update(kw), *cli.JOBS["train"][1:]))
    cli.main(["train", "--table", "t", "--output", "o", "--tag", "x", "--trials", "3"])
    assert seen == {"table": "t", "output": "o", "tag": "x", "trials": 3, "stopped": True}
    cli.main(["train", "--table", "t", "--output", "o", "--tag", "x", "--depth", "4", "--patience", "7"])
    assert (seen["base"].depth, seen["base"].patience, seen["base"].rounds) == (4, 7, 4000)
    monkeypatch.setitem(cli.JOBS, "training-features", (lambda spark, **kw: seen.update(kw), *cli.JOBS["training-features"][1:]))
    form = ["training-features", "--source", "s", "--begin", "b", "--end", "e", "--output", "o"]
    cli.main([*form, "--pitcher-ranks", "false", "--pitcher-key", "id", "--pitcher-ties", "all", "--league", "30"])
    assert (seen["pitcher_ranks"], seen["pitcher_spec"].entity, seen["pitcher_ties"], seen["league"]) == (False, ("player_id",), "all", 30)


def test_feature_output_can_be_run_again(spark, tmp_path):
    import datetime

    import pytest

    from formline.plans.jobs import FEATURE_PARTITIONS
    from formline.sources.tables import scan_parquet, sink_parquet

    path = str(tmp_path / "features")
    day = lambda m, d: datetime.date(2024, m, d)
    rows = lambda *days: spark.createDataFrame([(i, 2024, d) for i, d in days], "GamePK long, Season int, OfficialDate date")
    for run in (rows((1, day(4, 1)), (2, day(4, 2))), rows((3, day(5, 1))), rows((3, day(5, 1)))):
        sink_parquet(run, path, "overwrite", FEATURE_PARTITIONS)
    assert sorted(r.GamePK for r in scan_parquet(spark, path).collect()) == [1, 2, 3]
    sink_parquet(rows((4, day(5, 2))), path, "append", FEATURE_PARTITIONS)
    kept = scan_parquet(spark, path)
    assert sorted(r.GamePK for r in kept.collect()) == [1, 2, 3, 4]
    plan = kept.where("Season = 2024 and OfficialDate = date '2024-05-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(Season" in plan
    with pytest.raises(ValueError, match="another layout"):
        sink_parquet(rows((5, day(5, 3))), path, "append")
