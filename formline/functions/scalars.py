"""Column expressions of the feature and scoring jobs. All stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def batting_average(hits: Column | str, atbats: Column | str) -> Column:
    """Hits per at-bat; NULL without at-bats (ANSI mode would raise on ``/``)."""
    return F.try_divide(_col(hits).cast("double"), _col(atbats))


def walks_total(walks: Column | str, intentional: Column | str) -> Column:
    return _col(walks) + _col(intentional)


def win_loss_ratio(wins: Column | str, losses: Column | str) -> Column:
    """``wins / (losses + 1)``: also used across teams for wins-to-wins ratios."""
    return F.try_divide(_col(wins).cast("double"), _col(losses) + 1)


cross_team_ratio = win_loss_ratio


def days_rest(game_date: Column | str, last_date: Column | str) -> Column:
    return F.datediff(_col(game_date), _col(last_date))


def game_month(game_date: Column | str) -> Column:
    return F.month(_col(game_date))


def home_win_flag(home_runs: Column | str, away_runs: Column | str) -> Column:
    """1 when the home side scored more; ties and unknown scores give 0."""
    return F.when(_col(home_runs) > _col(away_runs), 1).otherwise(0)


def home_win_label(home_runs, away_runs, state: Column | str) -> Column:
    """As ``home_win_flag``, but unknown until the game is final."""
    return F.when(_col(state) == "Final", home_win_flag(home_runs, away_runs))


def round1(value: Column | str) -> Column:
    return F.round(_col(value), 1)


def threshold_flag(value: Column | str, threshold: float = 0.5) -> Column:
    return F.when(_col(value) > threshold, 1).otherwise(0)


def correct_flag(predicted: Column | str, actual: Column | str) -> Column:
    return F.when(_col(predicted) == _col(actual), 1).otherwise(0)


def yrmo(season: Column | str, month: Column | str) -> Column:
    """Season followed by the two-digit month, e.g. ``202408``."""
    return F.concat(_col(season).cast("string"), F.lpad(_col(month).cast("string"), 2, "0"))


def ratio_pct(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(_col(part).cast("double"), _col(whole))


def to_day(value: Column | str) -> Column:
    return F.to_date(_col(value))


def season_of(value: Column | str) -> Column:
    """Season of a date or of a ``yyyy-...`` text."""
    return F.year(F.to_date(_col(value)))


def strip_dashes(value: Column | str) -> Column:
    return F.date_format(_col(value), "yyyyMMdd")


def sentinel_default(value: Column | str, default) -> Column:
    return F.coalesce(_col(value), F.lit(default))


def batch_stamp(df: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Tag rows with the time of the run, or with a given stamp for repeatable output."""
    return df.withColumn("batch", F.current_timestamp() if stamp is None else stamp)


def date_series(spark: SparkSession, begin: str, end: str) -> DataFrame:
    """One row per day from ``begin`` to ``end``, both included; empty when reversed."""
    ends = spark.range(1).select(F.lit(begin).cast("date").alias("b"), F.lit(end).cast("date").alias("e"))
    return ends.where("b <= e").select(F.explode(F.sequence("b", "e")).alias("officialdate"))


def iso_at_ten(value: Column | str) -> Column:
    """The snapshot instant of a day: ISO text at ten o'clock UTC."""
    return F.concat(F.date_format(_col(value), "yyyy-MM-dd"), F.lit("T10:00:00Z"))
