import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import datasets, metrics, model

FEATURES = ["signal", "noise", "other"]
QUICK = model.TreeParams(depth=2, rounds=5, step=0.3)


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(2)
    data = []
    for i in range(1200):
        signal = draw.random()
        won = int(draw.random() < (0.9 if signal > 0.5 else 0.1))
        data.append((i, 2021 + i % 5, signal, draw.random(), draw.random(), won, 1 + i % 9))
    df = spark.createDataFrame(
        data, "GamePK int, season int, signal double, noise double, other double, HomeTeamWin int, game_month int"
    )
    return datasets.season_split(df, 2023, 2024).persist()


def fit(rows, **kwargs):
    return model.train_classifier(rows.where("dataset = 'train'"), FEATURES, params=QUICK, **kwargs)


def loss(df):
    return metrics.evaluate(df, ["log_loss"], datasets.LABEL, model.PREDICTION).first()[0]


def test_split_by_season(rows):
    got = {(r.season, r.dataset) for r in rows.select("season", "dataset").distinct().collect()}
    assert got == {(2021, "train"), (2022, "train"), (2023, "validation"), (2024, "test"), (2025, None)}


def test_fit_is_repeatable_and_beats_a_constant(rows):
    one, two = (model.score(fit(rows), rows) for _ in range(2))
    assert rows_of(one, ["GamePK", model.PREDICTION]) == rows_of(two, ["GamePK", model.PREDICTION])
    held = one.where("dataset = 'test'")
    constant = held.withColumn(model.PREDICTION, F.lit(0.5))
    assert loss(held) < 0.8 * loss(constant)


def test_saved_model_scores_the_same(rows, tmp_path):
    fitted = fit(rows)
    path = str(tmp_path / "m")
    for _ in range(2):
        model.save_model(fitted, path)
    again = model.load_model(path)
    assert rows_of(model.score(fitted, rows)) == rows_of(model.score(again, rows))


def test_scored_splits_and_games(rows):
    fitted = fit(rows)
    scored = model.score_splits(fitted, rows.union(rows))
    assert scored.count() == rows.where("dataset is not null").count()
    games = model.score_games(fitted, rows).select(model.PREDICTION, "rounded", "pred_home_win").collect()
    assert all(0 <= r[0] <= 1 and abs(r[1] - r[0]) <= 0.05 + 1e-9 and r[2] == int(r[0] > 0.5) for r in games)


def test_early_stopping_needs_fewer_rounds(rows):
    params = model.TreeParams(depth=3, rounds=12, step=0.9, patience=5)
    fitted = model.train_classifier(
        rows.where("dataset in ('train', 'validation')"), FEATURES, params=params, held_out="dataset = 'validation'"
    )
    assert fitted.stages[-1].getNumTrees < 12


def held_rows(rows, fitted):
    return fitted.stages[0].transform(rows.where("dataset = 'validation'"))


@pytest.mark.parametrize("kind, label", [("classifier", "HomeTeamWin"), ("regressor", "signal")])
def test_a_truncated_model_is_the_fit_of_fewer_rounds(rows, tmp_path, kind, label):
    train, features = rows.where("dataset = 'train'"), ["noise", "other", "game_month"]
    few, many = (model.fit_trees(train, features, label, model.TreeParams(depth=2, rounds=n, rows=0.7), kind) for n in (3, 8))
    cut = model.truncated(many, 3)
    assert cut.stages[-1].getNumTrees == 3 and model.truncated(few, 5) is few
    assert rows_of(model.score(cut, rows)) == rows_of(model.score(few, rows))
    assert cut.stages[-1].featureImportances == few.stages[-1].featureImportances
    model.save_model(cut, str(tmp_path / "m"))
    assert rows_of(model.score(model.load_model(str(tmp_path / "m")), rows)) == rows_of(model.score(few, rows))


def test_patience_stops_the_rounds_at_the_least_loss(rows, monkeypatch):
    """4,000 rounds are allowed; three fits of 4, 8 and 16 rounds are enough, and none is repeated."""
    monkeypatch.setattr(model, "FIRST_ROUNDS", 4)
    fits, estimator = [], model._estimator
    monkeypatch.setattr(model, "_estimator", lambda kind, params, label: fits.append(params.rounds) or estimator(kind, params, label))
    params = model.TreeParams(depth=3, rounds=4000, step=0.5, patience=3)
    both = rows.where("dataset in ('train', 'validation')")
    fitted = model.train_classifier(both, FEATURES, params=params, held_out="dataset = 'validation'")
    assert fits == [4 * 2**i for i in range(len(fits))] and fits[-1] < 64
    whole = model.train_classifier(rows.where("dataset = 'train'"), FEATURES, params=model.TreeParams(depth=3, rounds=fits[-1], step=0.5))
    losses = model.round_losses(whole, held_rows(rows, whole))
    kept = fitted.stages[-1].getNumTrees
    assert kept == model.kept_rounds(losses, 3) < fits[-1] and losses[kept - 1] == min(losses[: kept + 3])


def test_a_fit_has_as_many_tasks_as_its_rows_need(rows, monkeypatch):
    """Each task puts out the statistics of all nodes at every level; few rows in many partitions are dealt to few tasks."""
    seen, fit_stages = [], model.Pipeline.fit
    monkeypatch.setattr(model.Pipeline, "fit", lambda self, data: seen.append(data.rdd.getNumPartitions()) or fit_stages(self, data))
    dealt = rows.repartition(24, "GamePK")
    fit(dealt)
    both = dealt.where("dataset in ('train', 'validation')")
    model.train_classifier(both, FEATURES, params=QUICK, held_out="dataset = 'validation'")
    assert seen == [1, 1]
    monkeypatch.setattr(model, "ROWS_PER_TASK", 100)
    assert model.fit_tasks(dealt.limit(250)) == 3
    # Eight cores; four fits at once have two each. Tasks hold bounded rows all the same.
    assert (model.fit_tasks(dealt), model.fit_tasks(dealt, 4)) == (8, 2)
    monkeypatch.setattr(model, "MOST_ROWS_PER_TASK", 120)
    assert model.fit_tasks(dealt, 4) == 10


def test_halving_drops_the_worst_and_finishes_the_best(rows, monkeypatch):
    monkeypatch.setattr(model, "FIRST_ROUNDS", 8)
    base = model.TreeParams(rounds=12, patience=3)
    search = model.hyperparam_search(rows, FEATURES, datasets.LABEL, trials=6, base=base, first_rounds=1, keep=3)
    table = {r.trial: r for r in model.trials_table(search, rows).collect()}
    assert len(table) == 6 and len(search.finished) == 1
    # Six trials of one round, two of three, one to the end.
    left = {i for i, r in table.items() if r.rounds == 1 and not r.finished}
    assert len(left) >= 4 and max(r.log_loss for i, r in table.items() if i not in left) <= min(table[i].log_loss for i in left)
    assert search.best == search.trials[search.finished[0]][0]


def test_the_search_goes_on_from_its_last_step(rows, monkeypatch):
    """The draw left has its four rounds from the last step: no fit is made twice."""
    monkeypatch.setattr(model, "FIRST_ROUNDS", 4)
    fits, estimator = [], model._estimator
    monkeypatch.setattr(model, "_estimator", lambda kind, params, label: fits.append((params.step, params.rounds)) or estimator(kind, params, label))
    base = model.TreeParams(rounds=16, patience=2)
    search = model.hyperparam_search(rows, FEATURES, datasets.LABEL, trials=2, base=base, first_rounds=4)
    assert [n for _, n in fits].count(4) == 2 and len(set(fits)) == len(fits) and len(search.finished) == 1


def test_a_fit_goes_on_where_one_of_its_own_would_stop(rows, monkeypatch):
    monkeypatch.setattr(model, "FIRST_ROUNDS", 4)
    params = model.TreeParams(depth=3, rounds=64, step=0.5, rows=0.7, patience=2)
    both = rows.where("dataset in ('train', 'validation')")
    first = model.fit_trees(both.where("dataset = 'train'"), FEATURES, datasets.LABEL, model.replace(params, rounds=4), "classifier")
    one, two = (
        model.fit_trees(both, FEATURES, datasets.LABEL, params, "classifier", "dataset = 'validation'", grown=g).stages[-1] for g in (first, None)
    )
    assert one.getNumTrees == two.getNumTrees and one.featureImportances == two.featureImportances


def test_search_is_seeded_and_keeps_its_ranges(rows):
    draws = model.draw_params(50)
    assert draws == model.draw_params(50) and draws != model.draw_params(50, seed=1)
    assert all(3 <= d.depth <= 10 and 0.01 <= d.step <= 0.3 and 0.6 <= d.rows <= 1 and 0.6 <= d.columns <= 1 for d in draws)
    assert all(0 < d.step <= 0.5 for d in model.draw_params(50, model.REGRESSION_RANGES))
    search = model.hyperparam_search(rows, FEATURES, datasets.LABEL, trials=2, base=QUICK)
    table = model.trials_table(search, rows).collect()
    assert len(table) == 2 and min(r.log_loss for r in table) == dict((p, m) for p, m in search.trials)[search.best]


def test_regressor_tracks_the_target(rows):
    data = rows.withColumn("target", F.col("signal") * 10)
    params = model.TreeParams(depth=3, rounds=10, step=0.5)
    scored = model.score(model.train_regressor(data, FEATURES, "target", params), data)
    assert metrics.evaluate(scored, ["mae"], "target", model.PREDICTION).first()[0] < 1.5


def test_importance_finds_the_signal(rows):
    got = model.feature_importance(fit(rows), rows.where("dataset = 'train'"), FEATURES, datasets.LABEL).collect()
    by = {r.feature: r for r in got}
    assert set(by) == set(FEATURES)
    assert by["signal"].log_loss_increase > 0.2 and abs(by["noise"].log_loss_increase) < 0.05
    assert by["signal"].split_importance > 0.8
    assert 0 < by["signal"].log_loss_increase_error < 0.1 * by["signal"].log_loss_increase


def test_importance_of_a_constant_and_of_the_label_itself(rows):
    data = rows.where("dataset = 'train'").withColumns({"constant": F.lit(1.0), "planted": F.col("HomeTeamWin").cast("double")})
    features = ["noise", "constant", "planted"]
    fitted = model.train_classifier(data, features, params=QUICK)
    by = {r.feature: r for r in model.feature_importance(fitted, data, features, datasets.LABEL, repeats=3).collect()}
    assert by["constant"].log_loss_increase == by["constant"].log_loss_increase_error == by["constant"].split_importance == 0
    assert by["planted"].log_loss_increase > 10 * max(by["planted"].log_loss_increase_error, abs(by["noise"].log_loss_increase))


def test_shuffling_is_a_permutation(rows):
    mixed = model._with_shifted(rows.select(*FEATURES, datasets.LABEL), FEATURES, 1).select("_own", "_other").collect()
    assert sorted(tuple(r._own) for r in mixed) == sorted(tuple(r._other) for r in mixed)
    assert sum(tuple(r._own) == tuple(r._other) for r in mixed) < 5


def test_kept_rounds_follow_the_least_loss():
    assert model.kept_rounds([3, 2, 1, 2, 2, 0.5], 2) == 3
    assert model.kept_rounds([3, 2, 1, 2, 2, 0.5], 4) == 6
    assert model.kept_rounds([1.0], 5) == 1


def test_a_game_without_a_feature_keeps_its_row(rows):
    from pyspark.sql import functions as F

    features = ["signal", "noise", "other"]
    fitted = model.train_classifier(rows.where("dataset = 'train'"), features, "HomeTeamWin", QUICK)
    holed = rows.withColumn("noise", F.when(F.col("GamePK") % 2 == 0, F.col("noise")))
    scored = model.score(fitted, holed)
    assert scored.count() == rows.count()
    assert scored.where("(model_prediction is null) <> (noise is null)").count() == 0
