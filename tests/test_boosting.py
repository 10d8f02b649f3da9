"""Trees grown on a compact copy of the rows, held against Spark's; a search that runs every draw to its least loss."""

import math
import random
from dataclasses import replace

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import boosting, datasets, model

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Features of at most 30 values: then Spark's thresholds lie between all of them, whatever rows it looks at."""
    draw = random.Random(5)
    data = []
    for i in range(1500):
        a, b, c = draw.randrange(30), draw.randrange(12), draw.randrange(3)
        won = int(draw.random() < 1 / (1 + math.exp((15 - a) / 6 + (b - 6) / 3 + (1 - c))))
        data.append((i, 2021 + i % 4, float(a), b, float(c) / 2, won, 2.0 * a + b * c + draw.random()))
    df = spark.createDataFrame(data, "GamePK int, season int, a double, b int, c double, HomeTeamWin int, target double")
    return datasets.season_split(df, 2023, 2024).persist()


def predicted(fitted, rows):
    return {r.GamePK: r[model.PREDICTION] for r in model.score(fitted, rows).select("GamePK", model.PREDICTION).collect()}


# In small nodes many splits gain the same, and either may be taken: trees that deep aren't compared.
@pytest.mark.parametrize("kind, label, features, depth", [
    ("classifier", "HomeTeamWin", FEATURES, 1), ("classifier", "HomeTeamWin", FEATURES, 4), ("classifier", "HomeTeamWin", ["a", "b"], 4),
    ("regressor", "target", FEATURES, 1), ("regressor", "target", FEATURES, 4),
])
def test_trees_are_those_of_spark(rows, tmp_path, kind, label, features, depth):
    train, params = rows.where("dataset = 'train'"), model.TreeParams(depth=depth, rounds=5, step=0.4)
    theirs, own = (model.fit_trees(train, features, label, params, kind, compact=c) for c in (False, True))
    expected = predicted(theirs, rows)
    assert predicted(own, rows) == pytest.approx(expected, rel=1e-9, abs=1e-9)
    one, two = theirs.stages[-1], own.stages[-1]
    assert one.getNumTrees == two.getNumTrees and one.treeWeights == two.treeWeights
    assert two.featureImportances.toArray() == pytest.approx(one.featureImportances.toArray(), abs=1e-6)
    assert all(two.getOrDefault(p) == one.getOrDefault(p) for p in ("labelCol", "maxDepth", "stepSize", "maxIter"))
    # What is stored, cut or asked for its losses is a model like any other.
    held = own.stages[0].transform(rows.where("dataset = 'validation'"))
    assert model.round_losses(own, held) == pytest.approx(model.round_losses(theirs, held))
    model.save_model(own, str(tmp_path / "m"))
    assert predicted(model.load_model(str(tmp_path / "m")), rows) == predicted(own, rows)
    assert predicted(model.truncated(own, 2), rows) == pytest.approx(predicted(model.truncated(theirs, 2), rows), rel=1e-9, abs=1e-9)


def test_patience_keeps_the_rounds_of_the_least_loss(rows):
    both, params = rows.where("dataset in ('train', 'validation')"), model.TreeParams(depth=2, rounds=4000, step=0.2, patience=4)
    one, two = (
        model.fit_trees(both, FEATURES, "HomeTeamWin", params, "classifier", "dataset = 'validation'", compact=c) for c in (False, True)
    )
    assert 1 < two.stages[-1].getNumTrees == one.stages[-1].getNumTrees < 100
    assert predicted(two, rows) == pytest.approx(predicted(one, rows), rel=1e-9, abs=1e-9)


def test_a_search_runs_every_draw_to_its_least_loss(rows, monkeypatch):
    base, draw = model.TreeParams(rounds=200, patience=5), model.draw_params
    whole = lambda *a: [replace(p, rows=1.0, columns=1.0, depth=1 + i % 3) for i, p in enumerate(draw(*a))]
    monkeypatch.setattr(model, "draw_params", whole)
    search = model.hyperparam_search(rows, FEATURES, datasets.LABEL, trials=12, base=base)
    assert search.finished == list(range(12)) and len(search.trials) == 12
    assert search.best == min(search.trials, key=lambda t: t[1])[0]
    table = model.trials_table(search, rows).collect()
    assert all(r.finished for r in table) and sum(r.rounds > 2 for r in table) > 6
    train, held = rows.where("dataset = 'train'"), rows.where("dataset = 'validation'")
    for drawn, (params, loss) in list(zip(whole(12, model.BINARY_RANGES, model.SEED, base), search.trials, strict=True))[:3]:
        assert params == replace(drawn, rounds=params.rounds)
        longer = replace(params, rounds=min(base.rounds, params.rounds + base.patience))
        fitted = model.train_classifier(train, FEATURES, params=longer)
        losses = model.round_losses(fitted, fitted.stages[0].transform(held))
        assert model.kept_rounds(losses, base.patience) == params.rounds and min(losses) == losses[params.rounds - 1]
        # Spark's loss is twice the log loss.
        assert loss == pytest.approx(losses[params.rounds - 1] / 2)


@pytest.mark.parametrize("kind, label", [("classifier", "HomeTeamWin"), ("regressor", "target")])
def test_rows_no_task_can_hold_are_searched_by_distributed_fits(rows, monkeypatch, kind, label):
    base = model.TreeParams(rounds=6, patience=2)
    whole = model.hyperparam_search(rows, FEATURES, label, kind, trials=2, base=base)
    monkeypatch.setattr(boosting, "MOST_VALUES_EACH", 1_000)
    monkeypatch.setattr(boosting, "binned", None)
    search = model.hyperparam_search(rows, FEATURES, label, kind, trials=2, base=base)
    assert search.finished == whole.finished == [0, 1] and search.metric == whole.metric
    assert [m for _, m in search.trials] == pytest.approx([m for _, m in whole.trials], rel=0.3)


def test_rows_beyond_one_task_are_fitted_on_their_compact_copy(rows, monkeypatch):
    fits, fit_stages = [], model.Pipeline.fit
    monkeypatch.setattr(model.Pipeline, "fit", lambda self, data: fits.append(data) or fit_stages(self, data))
    train, params = rows.where("dataset = 'train'"), model.TreeParams(depth=3, rounds=4, step=0.3)
    theirs = predicted(model.train_classifier(train, FEATURES, params=params), rows)
    monkeypatch.setattr(model, "ROWS_PER_TASK", 200)
    assert predicted(model.train_classifier(train, FEATURES, params=params), rows) == pytest.approx(theirs, rel=1e-9, abs=1e-9)
    assert len(fits) == 1
    monkeypatch.setattr(boosting, "MOST_VALUES", 1_000)
    assert predicted(model.train_classifier(train, FEATURES, params=params), rows) == pytest.approx(theirs, rel=1e-9, abs=1e-9)
    assert len(fits) == 2


def test_incomplete_rows_are_not_fitted_and_what_spark_refuses_is_an_error(rows):
    train, params = rows.where("dataset = 'train'"), model.TreeParams(depth=3, rounds=3)
    odd = train.select("GamePK", "season", F.expr("if(GamePK % 3 = 0, null, a)").alias("a"), "b", F.expr("if(GamePK % 5 = 0, 'NaN', c)").cast("double").alias("c"), F.expr("if(GamePK % 7 = 0, null, HomeTeamWin)").alias("HomeTeamWin"))
    complete = train.where("GamePK % 3 > 0 and GamePK % 5 > 0 and GamePK % 7 > 0")
    one, two = (model.train_classifier(df, FEATURES, params=params, compact=True) for df in (odd, complete))
    assert rows_of(model.score(one, rows), ["GamePK", model.PREDICTION]) == rows_of(model.score(two, rows), ["GamePK", model.PREDICTION])
    with pytest.raises(Exception, match="0 or 1"):
        model.train_classifier(train.withColumn("HomeTeamWin", F.lit(2)), FEATURES, params=params, compact=True)
    with pytest.raises(Exception, match="finite"):
        model.train_classifier(train.withColumn("a", F.lit(float("inf"))), FEATURES, params=params, compact=True)


def test_samples_of_rows_and_features_follow_the_seed(rows):
    train = rows.where("dataset = 'train'")
    first, again, other = (
        predicted(model.train_classifier(train, FEATURES, params=model.TreeParams(rounds=5, rows=0.7, columns=0.6, seed=s), compact=True), rows)
        for s in (1, 1, 2)
    )
    assert first == again != other


def test_shares_are_even_and_hold_every_draw():
    draws = model.draw_params(100)
    shares = boosting.dealt(draws, 6)
    assert sorted(i for share in shares for i in share) == list(range(100))
    assert all(10 <= len(share) <= 24 for share in shares)
