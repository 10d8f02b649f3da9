import math
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.functions.normal import normal_cdf
from formline.operators import metrics


def pairs(spark, rows):
    return spark.createDataFrame(rows, "y double, p double")


def test_error_measures(spark):
    rows = [(3.0, 2.0), (0.0, 1.0), (5.0, 5.0)]
    got = metrics.evaluate(pairs(spark, rows), ["mae", "mse", "rmse", "msle", "mape"], "y", "p").first()
    assert got.mae == pytest.approx(2 / 3)
    assert got.mse == pytest.approx(2 / 3)
    assert got.rmse == pytest.approx(math.sqrt(2 / 3))
    assert got.msle == pytest.approx(((math.log(4) - math.log(3)) ** 2 + math.log(2) ** 2) / 3)
    assert got.mape == pytest.approx((1 / 6 + 1 / 3) / 3)


def test_log_loss_survives_certain_predictions(spark):
    got = metrics.evaluate(pairs(spark, [(1.0, 1.0), (0.0, 0.25), (1.0, 0.0)]), ["log_loss"], "y", "p").first().log_loss
    assert got == pytest.approx(-(math.log(0.75) + math.log(1e-15)) / 3, rel=1e-6)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_naive_error_in_order_over_any_partitioning(spark, partitions):
    draw = random.Random(5)
    values = [float(draw.randrange(50)) for _ in range(500)]
    expected = sum(abs(b - a) for a, b in zip(values, values[1:])) / 499
    shuffled = list(enumerate(values))
    draw.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "t int, y double").repartition(partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert metrics.naive_forecast_error(df, "y", ["t"]).first()[0] == pytest.approx(expected)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert metrics.naive_forecast_error(df, "y", ["t"]).first()[0] == pytest.approx(expected)
    two = df.withColumn("p", F.col("y") + 2)
    assert metrics.mase(two, "y", "p", df, "y", ["t"]).first()[0] == pytest.approx(2 / expected)


def test_normal_distribution(spark):
    zs = [-40.0, -8.2, -3.0, -1.0, 0.0, 0.3, 1.6448536269514722, 2.5, 6.0, 8.2, 40.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in df.select("z", normal_cdf(F.col("z")).alias("c")).collect():
        assert r.c == pytest.approx(0.5 * math.erfc(-r.z / math.sqrt(2)), abs=1e-14)


def test_summary_test_and_rollup(spark):
    rows = [(2023, 4, "validation", 0.7, 1)] * 70 + [(2023, 4, "validation", 0.7, 0)] * 30 + [(2024, 10, "test", 0.4, 1)] * 10
    df = spark.createDataFrame(rows, "season int, game_month int, dataset string, model_prediction double, HomeTeamWin int")
    labelled = metrics.label_predictions(df)
    assert rows_of(labelled.select("model_prediction", "rounded", "pred_binary").distinct()) == [
        (0.4, 0, 0.4), (0.7, 1, 0.7)
    ]
    summary = metrics.result_summary(labelled)
    tested = {r.dataset: r for r in metrics.accuracy_ztest(summary).collect()}
    april = tested["validation"]
    z = (0.7 - 0.55) / math.sqrt(0.55 * 0.45 / 100)
    assert (april.yrmo, april.games, april.correct) == ("202304", 100, 70)
    assert april.z_score == pytest.approx(z)
    assert april.p_value == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=1e-14)
    assert april[metrics.BETTER] == "Yes" and tested["test"][metrics.BETTER] == "No"
    assert tested["test"].yrmo == "202410"
    rolled = {r.dataset: r.pct for r in metrics.accuracy_rollup(summary).collect()}
    assert rolled == {"validation": 0.7, "test": 0.0}
