"""Time zones of home teams and shifts of UTC instants to local clocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_ZONE = "UTC"
EASTERN = "America/New_York"

# Zone of each home team's park.
TEAM_ZONES = {
    "Baltimore Orioles": "America/New_York",
    "Boston Red Sox": "America/New_York",
    "New York Yankees": "America/New_York",
    "Tampa Bay Rays": "America/New_York",
    "Toronto Blue Jays": "America/New_York",
    "Atlanta Braves": "America/New_York",
    "Miami Marlins": "America/New_York",
    "New York Mets": "America/New_York",
    "Philadelphia Phillies": "America/New_York",
    "Washington Nationals": "America/New_York",
    "Cleveland Guardians": "America/New_York",
    "Detroit Tigers": "America/New_York",
    "Pittsburgh Pirates": "America/New_York",
    "Cincinnati Reds": "America/New_York",
    "Chicago White Sox": "America/Chicago",
    "Kansas City Royals": "America/Chicago",
    "Minnesota Twins": "America/Chicago",
    "Houston Astros": "America/Chicago",
    "Texas Rangers": "America/Chicago",
    "Milwaukee Brewers": "America/Chicago",
    "St. Louis Cardinals": "America/Chicago",
    "Arizona Diamondbacks": "America/Phoenix",
    "Colorado Rockies": "America/Denver",
    "Los Angeles Angels": "America/Los_Angeles",
    "Los Angeles Dodgers": "America/Los_Angeles",
    "Oakland Athletics": "America/Los_Angeles",
    "San Diego Padres": "America/Los_Angeles",
    "San Francisco Giants": "America/Los_Angeles",
    "Seattle Mariners": "America/Los_Angeles",
}


def zone_table(spark: SparkSession, zones: dict[str, str] | None = None) -> DataFrame:
    """The dimension as a ``VALUES`` relation: Spark knows its size when it plans, and broadcasts it."""
    rows = sorted((TEAM_ZONES if zones is None else zones).items())
    if not rows:
        return spark.sql("SELECT '' AS team, '' AS tz WHERE false")
    values = ", ".join(f"(:team{i}, :tz{i})" for i in range(len(rows)))
    texts = {f"{name}{i}": text for i, row in enumerate(rows) for name, text in zip(("team", "tz"), row, strict=True)}
    return spark.sql(f"SELECT * FROM VALUES {values} AS zones(team, tz)", texts)


def dim_lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, default) -> DataFrame:
    """Add ``value`` from a dimension with one row per key, or the default where it has none.

    A key the dimension repeats is an error when the plan runs: it would multiply rows. The check is part of the
    dimension's side, whose size Spark estimates from the dimension; a small one is broadcast and ``df`` isn't shuffled.
    """
    several = F.raise_error(F.concat(F.lit(f"repeated key in {dim_key}: "), F.col("_dim_key").cast("string")))
    side = dim.where(F.col(dim_key).isNotNull()).groupBy(F.col(dim_key).alias("_dim_key")).agg(
        F.any_value(value).alias("_dim_value"), F.count(F.lit(1)).alias("_rows")
    )
    side = side.select("_dim_key", F.when(F.col("_rows") > 1, several).otherwise(F.col("_dim_value")).alias("_dim_value"))
    return df.join(side, F.col(key) == F.col("_dim_key"), "left").select(
        *df.columns, F.coalesce("_dim_value", F.lit(default)).alias(value)
    )


def utc_instant(value: Column | str) -> Column:
    """Text such as ``2024-08-16T17:05:00Z`` as an instant; unreadable text gives NULL."""
    value = F.col(value) if isinstance(value, str) else value
    return value.try_cast("timestamp")


def utc_to_zone(value: Column | str, zone: Column | str) -> Column:
    """Shift a UTC instant to the wall clock of a fixed zone (text) or of a zone per row (column)."""
    return F.from_utc_timestamp(value, F.lit(zone) if isinstance(zone, str) else zone)
