"""Betting odds: nested snapshots to rows, prices by bookmaker, local start times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.functions.zones import DEFAULT_ZONE, EASTERN, dim_lookup, utc_instant, utc_to_zone
from formline.operators.ranks import rank_within
from formline.schemas import ODDS_EVENT

EVENT_FIELDS = ["sport_key", "sport_title", "away_team", "home_team", "id", "commence_time"]
EVENT_KEYS = ["id", "commence_time", "away_team", "home_team"]

# Bookmakers laid out as columns.
BOOKMAKERS = ["mybookieag", "betmgm", "draftkings", "betrivers", "fanduel", "bet365"]

# The first price of a bookmaker by update times; the market decides between equal times, then the price.
PRICE_ORDER = ("bookmaker_last_update", "market_last_update", "market_key")


def parse_odds_event(df: DataFrame, column: str = "data") -> DataFrame:
    """Six event columns and ``bookmakers`` from an event struct, or from its JSON text.

    An unreadable event gives NULL columns and no bookmakers, as does a missing field.
    """
    if dict(df.dtypes)[column] == "string":
        df = df.withColumn(column, F.from_json(column, ODDS_EVENT))
    return df.select(
        *df.columns,
        *[F.col(f"{column}.{f}").alias(f) for f in EVENT_FIELDS],
        F.coalesce(F.col(f"{column}.bookmakers"), F.array()).alias("bookmakers"),
    )


def unpivot_bookmakers(events: DataFrame) -> DataFrame:
    """One row per event, bookmaker, market and outcome; events without outcomes have none."""
    books = events.select(*EVENT_FIELDS, F.inline("bookmakers")).withColumnsRenamed({
        "key": "bookmaker_key", "title": "bookmaker_title", "last_update": "bookmaker_last_update",
    })
    book = [*EVENT_FIELDS, "bookmaker_title", "bookmaker_key", "bookmaker_last_update"]
    markets = books.select(*book, F.inline("markets")).withColumnsRenamed({
        "key": "market_key", "last_update": "market_last_update",
    })
    return markets.select(*book, "market_key", "market_last_update", F.inline("outcomes")).withColumnsRenamed({
        "name": "outcome_name", "price": "outcome_price",
    })


def filter_in_list(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def _first_price(book: str, order: Sequence[str], extra=None):
    """Price of a bookmaker's earliest row with a price; prices break ties, so the pick is stable."""
    chosen = (F.col("bookmaker_key") == book) & F.col("outcome_price").isNotNull()
    if extra is not None:
        chosen = chosen & extra
    return F.min_by(F.when(chosen, F.col("outcome_price")), F.when(chosen, F.struct(*order, "outcome_price")))


def _priced(df: DataFrame, keys: Sequence[str], index: Sequence[str]) -> DataFrame:
    rows = filter_in_list(df, "bookmaker_key", keys).where(F.col("outcome_price").isNotNull())
    return rows.na.drop(how="any", subset=list(index))


def pivot_odds_by_book(
    rows: DataFrame, bookmakers: Sequence[str] = BOOKMAKERS, order: Sequence[str] = PRICE_ORDER
) -> DataFrame:
    """One row per event and outcome with a price column per bookmaker.

    One aggregation with a conditional aggregate per column: combined map-side, one shuffle.
    Rows with a NULL key have no group.
    """
    index = [*EVENT_KEYS, "outcome_name"]
    return _priced(rows, bookmakers, index).groupBy(*index).agg(
        *[_first_price(b, order).alias(b) for b in bookmakers]
    )


def side_filter(rows: DataFrame, side: str) -> DataFrame:
    """Outcomes on the ``home`` or ``away`` team."""
    return rows.where(F.col("outcome_name") == F.col(f"{side}_team"))


def merge_home_away_odds(
    rows: DataFrame, bookmakers: Sequence[str] = BOOKMAKERS, order: Sequence[str] = PRICE_ORDER
) -> DataFrame:
    """One row per event with both sides' outcome and prices, suffixed ``_away`` and ``_home``.

    Equal to pivoting, splitting by side and joining the halves, done in one aggregation;
    events priced on one side only are left out, as an inner join would.
    """
    sides = {s: F.col("outcome_name") == F.col(f"{s}_team") for s in ("away", "home")}
    prices = [
        _first_price(b, order, on_side).alias(f"{b}_{side}") for side, on_side in sides.items() for b in bookmakers
    ]
    names = [F.max(F.when(on, F.col("outcome_name"))).alias(f"outcome_name_{side}") for side, on in sides.items()]
    merged = _priced(rows, bookmakers, [*EVENT_KEYS, "outcome_name"]).groupBy(*EVENT_KEYS).agg(*names, *prices)
    merged = merged.where(F.col("outcome_name_away").isNotNull() & F.col("outcome_name_home").isNotNull())
    return merged.select(
        *EVENT_KEYS,
        *[f"{c}_{side}" for side in sides for c in ("outcome_name", *bookmakers)],
    )


def daily_game_number(events: DataFrame, limit: int | None = None) -> DataFrame:
    """``gameNumber``: order of an event's start among its home team's events of the Eastern day.

    The events come out of nested documents; they are computed once and stored.
    """
    dated = events.withColumn("officialDate", F.to_date("eastern_commence_time"))
    return rank_within(dated, ["home_team", "officialDate"], "eastern_commence_time", "gameNumber", True, limit, derived=True)


def localize_odds(odds: DataFrame, zones: DataFrame) -> DataFrame:
    """Add local and Eastern start times, official date and number of the game that day.

    Times and numbers are added in place: joining the table to itself on event, time and
    home team would give the same rows while those keys are unique, and multiply copies.
    """
    instant = utc_instant("commence_time")
    zoned = dim_lookup(odds, zones, "home_team", "team", "tz", DEFAULT_ZONE)
    timed = zoned.withColumns({
        "local_commence_time": utc_to_zone(instant, F.col("tz")),
        "eastern_commence_time": utc_to_zone(instant, EASTERN),
    }).drop("tz")
    return daily_game_number(timed)
