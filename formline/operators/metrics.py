"""Error measures, result summaries and the accuracy test. Each is one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formline.functions import scalars
from formline.functions.normal import normal_cdf

PROBABILITY_FLOOR = 1e-15
MAPE_OFFSET = 3
NULL_RATE = 0.55
ALPHA = 0.05
BETTER = "better_than_55%"


def _pair(y: str, p: str) -> tuple[Column, Column]:
    return F.col(y).cast("double"), F.col(p).cast("double")


def mae(y: str, p: str) -> Column:
    y, p = _pair(y, p)
    return F.avg(F.abs(y - p))


def mse(y: str, p: str) -> Column:
    y, p = _pair(y, p)
    return F.avg((y - p) * (y - p))


def rmse(y: str, p: str) -> Column:
    return F.sqrt(mse(y, p))


def msle(y: str, p: str) -> Column:
    y, p = _pair(y, p)
    gap = F.log1p(y) - F.log1p(p)
    return F.avg(gap * gap)


def mape(y: str, p: str) -> Column:
    """Absolute error relative to the label plus three, which keeps small counts from dominating."""
    y, p = _pair(y, p)
    return F.avg(F.abs(F.try_divide(y - p, y + MAPE_OFFSET)))


def log_loss(y: str, p: str) -> Column:
    """Mean negative log likelihood; probabilities are kept off 0 and 1."""
    y, p = _pair(y, p)
    p = F.least(F.greatest(p, F.lit(PROBABILITY_FLOOR)), F.lit(1 - PROBABILITY_FLOOR))
    return -F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))


METRICS = {"mae": mae, "mse": mse, "rmse": rmse, "msle": msle, "mape": mape, "log_loss": log_loss}


def evaluate(df: DataFrame, names: Sequence[str], y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Any number of metrics in one pass, overall or by group."""
    return df.groupBy(*by).agg(*[METRICS[n](y, p).alias(n) for n in names])


def naive_forecast_error(df: DataFrame, y: str, order: Sequence[str]) -> DataFrame:
    """Mean absolute step between neighbours in the order of the whole table.

    Rows are range-partitioned by the order, so each task holds a run of it. A task gives its
    inner steps and its end points; the steps between runs come from that short table.
    """
    runs = (
        df.select(*order, F.col(y).cast("double").alias("_y"))
        .repartitionByRange(*order)
        .withColumn("_run", F.spark_partition_id())
    )
    inside = W.partitionBy("_run").orderBy(*order)
    at = F.struct(*order)
    per_run = (
        runs.withColumn("_step", F.abs(F.col("_y") - F.lag("_y").over(inside)))
        .groupBy("_run")
        .agg(
            F.sum("_step").alias("_total"), F.count("_step").alias("_steps"),
            F.min_by("_y", at).alias("_head"), F.max_by("_y", at).alias("_tail"),
        )
    )
    edge = F.abs(F.col("_head") - F.lag("_tail").over(W.orderBy("_run")))
    return per_run.withColumn("_edge", edge).agg(
        F.try_divide(
            F.coalesce(F.sum("_total"), F.lit(0.0)) + F.coalesce(F.sum("_edge"), F.lit(0.0)),
            F.sum("_steps") + F.count("_edge"),
        ).alias("naive_forecast_error")
    )


def mase(df: DataFrame, y: str, p: str, train: DataFrame, train_y: str, order: Sequence[str]) -> DataFrame:
    """Error relative to the naive step of the training labels, from two one-row tables."""
    parts = df.agg(mae(y, p).alias("_mae")).unionByName(
        naive_forecast_error(train, train_y, order), allowMissingColumns=True
    )
    return parts.agg(F.try_divide(F.max("_mae"), F.max("naive_forecast_error")).alias("mase"))


def label_predictions(df: DataFrame, prediction: str = "model_prediction", label: str = "HomeTeamWin") -> DataFrame:
    flagged = df.withColumns({
        "rounded": scalars.round1(prediction), "pred_binary": scalars.threshold_flag(prediction),
    })
    return flagged.withColumn("correct", scalars.correct_flag("pred_binary", label))


def result_summary(df: DataFrame, prediction: str = "model_prediction") -> DataFrame:
    """Mean prediction, games and hits by season, month and dataset."""
    return (
        df.groupBy("season", "game_month", "dataset")
        .agg(
            F.avg(prediction).alias("avg_model_prediction"),
            F.count(F.lit(1)).alias("games"),
            F.sum("correct").alias("correct"),
        )
        .withColumns({
            "yrmo": scalars.yrmo("season", "game_month"), "pct": scalars.ratio_pct("correct", "games"),
        })
    )


def accuracy_ztest(summary: DataFrame, null_rate: float = NULL_RATE, alpha: float = ALPHA) -> DataFrame:
    """One-sided test per row whether the success rate beats ``null_rate``."""
    rate = scalars.ratio_pct("correct", "games")
    tested = summary.withColumn("success_rate", rate).withColumn(
        "z_score",
        F.try_divide(F.col("success_rate") - null_rate, F.sqrt(F.lit(null_rate * (1 - null_rate)) / F.col("games"))),
    )
    tested = tested.withColumn("p_value", 1 - normal_cdf(F.col("z_score")))
    return tested.withColumn(BETTER, F.when(F.col("p_value") < alpha, "Yes").otherwise("No")).select(
        "dataset", "season", "game_month", "yrmo", "games", "correct", "success_rate", "z_score", "p_value", BETTER,
    )


def accuracy_rollup(summary: DataFrame) -> DataFrame:
    return summary.groupBy("dataset").agg(
        F.try_divide(F.sum("correct").cast("double"), F.sum("games")).alias("pct")
    )
