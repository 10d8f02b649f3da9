"""The jobs of the pipeline, as functions over a session, paths and dates.

A job is one lazy plan from input to output; nothing of the data passes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.functions.scalars import batch_stamp
from formline.functions.zones import zone_table
from formline.operators import metrics, model, odds
from formline.operators.datasets import HOME_WIN_FEATURES, LABEL, dataset_home_win, season_split
from formline.operators.flatten import flatten_all, flatten_games, stat_names
from formline.operators.form import latest_rows
from formline.operators.matchup import assemble_matchup
from formline.schemas import GAME_DOCUMENT, ODDS_SNAPSHOT
from formline.scratch import discard, new_folder
from formline.sources.documents import odds_of, parse_once
from formline.sources.tables import period_name, scan_parquet, sink_csv_period, sink_parquet, snapshot_tables

Tables = Mapping[str, DataFrame]
FEATURE_TABLES = ("games_history", "team_batting", "individual_pitching")
# Features are stored by day in every mode, so that a run of some days replaces or adds just these.
FEATURE_PARTITIONS = ("Season", "OfficialDate")
#: Games, 8 bytes each, that may be sent to every executor.
BROADCAST_GAMES = 1_000_000
#: Odds snapshots whose prices one task picks.
SNAPSHOTS_PER_TASK = 50_000


def load_tables(spark: SparkSession, source: str, names=FEATURE_TABLES) -> dict[str, DataFrame]:
    return {n: scan_parquet(spark, f"{source.rstrip('/')}/{n}") for n in names}


def snapshot(spark: SparkSession, source: str, target: str) -> list[str]:
    """CSV tables to Parquet."""
    return snapshot_tables(spark, source, target)


def sink_rejects(rejects: DataFrame, output: str, table: str, begin: str, end: str | None = None) -> str:
    """The lines of a period that could not be read; writing a period again replaces them."""
    path = f"{output.rstrip('/')}/rejects/{table}_{period_name(begin, end)}"
    sink_parquet(rejects, path)
    return path


def flatten(
    spark: SparkSession, documents: str, output: str, begin: str, end: str, scheduled: str | None = None,
    scheduled_date: str | None = None, compression: str = "none",
) -> dict[str, dict[str, int]]:
    """Game documents to the CSV tables of a period; scheduled games to their own table.

    Documents are parsed once and stored until their tables are. Every statistic that occurs in the period becomes a column. Lines that
    aren't documents go to ``<output>/rejects/<table>_<period>``; the numbers of lines read and rejected are returned.
    The tables are plain CSV, or with ``compression`` gzip, which takes about a tenth of the disk.
    """
    parsed = parse_once(spark, documents, GAME_DOCUMENT, "games")
    counts = {"games_history": parsed.counts}
    sink_rejects(parsed.rejects, output, "games_history", begin, end)
    docs = parsed.documents
    played = docs.where(F.col("gamedata.datetime.officialdate").between(F.lit(begin).cast("date"), F.lit(end).cast("date")))
    for table, rows in flatten_all(played, stat_names(played)).items():
        sink_csv_period(rows, output, table, begin, end, compression)
    discard(spark, parsed.folder)
    if scheduled:
        parsed = parse_once(spark, scheduled, GAME_DOCUMENT, "scheduled")
        counts["scheduled"] = parsed.counts
        sink_rejects(parsed.rejects, output, "scheduled", scheduled_date)
        games = flatten_games(parsed.documents)
        games = games.where(F.col("OfficialDate") == F.lit(scheduled_date).cast("date"))
        sink_csv_period(games, output, "scheduled", scheduled_date, compression=compression)
        discard(spark, parsed.folder)
    return counts


def _before(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """Rows that can count for as-of dates of these seasons: right season, earlier than the last date.

    Windows only look at older games, so the cut by date may stand below them and reach the scan.
    """
    return df.where(F.col("season").between(F.year(first), F.year(last)) & (F.col("officialdate") < last))


def _season_days(begin: str, end: str) -> int:
    """Upper bound of (season, date) pairs between two dates."""
    first, last = date.fromisoformat(begin), date.fromisoformat(end)
    return max(0, (last - first).days + 1) * (last.year - first.year + 1)


def training_features(tables: Tables, begin: str, end: str, **options) -> DataFrame:
    """Final games from ``begin`` to ``end`` with the form of both sides before each game.

    All dates form one plan; there is no loop over days. Several seasons are allowed.
    """
    first, last = F.lit(begin).cast("date"), F.lit(end).cast("date")
    games = tables["games_history"].where(
        (F.col("DetailedState") == "Final")
        & F.col("OfficialDate").between(first, last)
        & F.col("Season").between(F.year(first), F.year(last))
    )
    return assemble_matchup(
        games, _before(tables["team_batting"], first, last), _before(tables["individual_pitching"], first, last),
        **{"days": _season_days(begin, end), **options},
    )


def build_training_features(
    spark: SparkSession, source: str, begin: str, end: str, output: str | None = None, mode: str = "overwrite", **options
) -> DataFrame:
    rows = training_features(load_tables(spark, source), begin, end, **options)
    if output:
        sink_parquet(rows, output, mode, FEATURE_PARTITIONS)
    return rows


def prediction_features(tables: Tables, day: str, stamp: Column | None = None, **options) -> DataFrame:
    """Games scheduled on a date with the form before it, tagged with the run's ``batch`` time."""
    day = F.lit(day).cast("date")
    games = tables["scheduled"].where(F.col("OfficialDate") == day)
    rows = assemble_matchup(
        games, _before(tables["team_batting"], day, day), _before(tables["individual_pitching"], day, day),
        **{"days": 1, **options},
    )
    return batch_stamp(rows, stamp)


def build_prediction_features(
    spark: SparkSession, source: str, day: str, output: str | None = None, mode: str = "append",
    stamp: Column | None = None, **options,
) -> DataFrame:
    rows = prediction_features(load_tables(spark, source, (*FEATURE_TABLES[1:], "scheduled")), day, stamp, **options)
    if output:
        sink_parquet(rows, output, mode, FEATURE_PARTITIONS)
    return rows


def latest_batch(scheduled: DataFrame) -> DataFrame:
    """One row per game: the one of its newest batch.

    Most games have one row in the newest batch of all. Keys and batches alone tell which games have not; where these fit
    a broadcast, their rows alone are shuffled and sorted, and those of all others stay where they are.
    """
    if "batch" not in scheduled.columns:
        return scheduled
    # Rows of one batch that differ are decided by their other columns, not by chance.
    order = ["batch", *sorted(set(scheduled.columns) - {"GamePK", "batch"})]
    newest = scheduled.agg(F.max("batch")).first()[0]
    if newest is None:
        return latest_rows(scheduled, ["GamePK"], order)
    last = F.col("batch").eqNullSafe(F.lit(newest).cast(scheduled.schema["batch"].dataType))
    others = scheduled.groupBy(F.col("GamePK").alias("_game")).agg(F.count_if(last).alias("_n")).where("_n <> 1").select("_game")
    if others.limit(BROADCAST_GAMES + 1).count() > BROADCAST_GAMES:
        return latest_rows(scheduled, ["GamePK"], order)
    theirs = F.col("GamePK").eqNullSafe(F.col("_game"))
    plain = scheduled.where(last).join(F.broadcast(others), theirs, "left_anti")
    return plain.unionAll(latest_rows(scheduled.join(F.broadcast(others), theirs, "left_semi"), ["GamePK"], order))


def assemble(historical: DataFrame, scheduled: DataFrame, every_batch: bool = False) -> tuple[DataFrame, DataFrame]:
    """Model tables for training and for prediction."""
    games = scheduled if every_batch else latest_batch(scheduled)
    return dataset_home_win(historical), dataset_home_win(games, label_known="false")


def assemble_modeling_datasets(
    spark: SparkSession, historical: str, scheduled: str, output: str, mode: str = "overwrite", every_batch: bool = False
) -> tuple[str, str]:
    tables = assemble(scan_parquet(spark, historical), scan_parquet(spark, scheduled), every_batch)
    paths = tuple(f"{output.rstrip('/')}/model_home_away_{use}" for use in ("train", "predict"))
    for rows, path in zip(tables, paths):
        sink_parquet(rows, path, mode)
    return paths


@dataclass
class Training:
    model: PipelineModel
    search: model.Search
    scored: DataFrame
    summary: DataFrame
    accuracy: DataFrame
    accuracy_by_month: DataFrame


def train(
    table: DataFrame, validation: int, test: int, trials: int = 100,
    base: model.TreeParams = model.TreeParams(rounds=model.MOST_ROUNDS), parallelism: int = 2, features=HOME_WIN_FEATURES,
    search: model.Search | None = None,
) -> Training:
    """Search on the seasons before ``validation``, refit with that season added, score all splits.

    The refit runs for the rounds chosen in the search and does not look at the test season. A search
    that was made before on the same seasons can be given.
    """
    rows = season_split(table, validation, test)
    search = search or model.hyperparam_search(rows, features, LABEL, trials=trials, base=base, parallelism=parallelism)
    fitted = model.train_classifier(rows.where("dataset in ('train', 'validation')"), features, LABEL, search.best, compact=True)
    scored = metrics.label_predictions(model.score_splits(fitted, rows))
    summary = metrics.result_summary(scored)
    return Training(fitted, search, scored, summary, metrics.accuracy_rollup(summary), metrics.accuracy_ztest(summary))


def train_model(
    spark: SparkSession, table: str, output: str, tag: str, mode: str = "overwrite", validation: int = 2023,
    test: int = 2024, trials: int = 100, parallelism: int = 2,
    base: model.TreeParams = model.TreeParams(rounds=model.MOST_ROUNDS), stamp: Column | None = None,
) -> Training:
    """Train, and write scored rows, accuracy, importance and the model; ``batch`` tells runs in the tables apart."""
    done = train(scan_parquet(spark, table), validation, test, trials, base, parallelism)
    root = "/".join(filter(None, (output.rstrip("/"), tag)))
    # Scored once; the results below are those of this run, whatever earlier runs have left in the output.
    scored = new_folder(spark, "scored")
    sink_parquet(done.scored, scored)
    scored = scan_parquet(spark, scored)
    sink_parquet(scored, f"{root}/training_data_with_predictions", mode)
    summary = metrics.result_summary(scored)
    sink_parquet(batch_stamp(metrics.accuracy_rollup(summary), stamp), f"{root}/accuracy_55_test_result", mode)
    sink_parquet(batch_stamp(metrics.accuracy_ztest(summary), stamp), f"{root}/accuracy_55_test_detail", mode)
    rows = season_split(scan_parquet(spark, table), validation, test).where("dataset = 'train'")
    sink_parquet(
        model.feature_importance(done.model, rows, HOME_WIN_FEATURES, LABEL), f"{root}/feature_importance", mode
    )
    model.save_model(done.model, f"{root}/best_model")
    return done


def predict(
    spark: SparkSession, table: str, model_path: str, output: str | None = None, tag: str = "", mode: str = "overwrite"
) -> DataFrame:
    rows = model.score_games(model.load_model(model_path), scan_parquet(spark, table))
    if output:
        root = "/".join(filter(None, (output.rstrip("/"), tag)))
        sink_parquet(rows, f"{root}/game_predictions", mode)
    return rows


def format_odds(
    spark: SparkSession, snapshots: str, output: str | None = None, first: str | None = None, last: str | None = None,
    zones: DataFrame | None = None, mode: str = "overwrite", order: Sequence[str] = odds.PRICE_ORDER,
) -> DataFrame:
    """Odds snapshots to one row per event: prices of both sides by bookmaker, local start, game number.

    Snapshots are parsed once and stored. Lines that aren't snapshots go to ``<output>/rejects/odds``.
    """
    parsed = parse_once(spark, snapshots, ODDS_SNAPSHOT, "odds")
    if output:
        sink_parquet(parsed.rejects, f"{output.rstrip('/')}/rejects/odds", mode)
    events = odds_of(parsed.documents)
    # Prices are sorted per task, and stored snapshots are many to a split: events are dealt out by what they hold.
    tasks = -(-parsed.counts["read"] // SNAPSHOTS_PER_TASK)
    events = events.repartition(tasks, "data.id", "data.commence_time", "data.bookmakers") if tasks > 1 else events
    rows = odds.unpivot_bookmakers(odds.parse_odds_event(events))
    if first:
        rows = rows.where(F.col("commence_time") >= first)
    if last:
        rows = rows.where(F.substring("commence_time", 1, 10) <= last)
    formatted = odds.localize_odds(odds.merge_home_away_odds(rows, order=order), zones or zone_table(spark))
    if output:
        sink_parquet(formatted, f"{output.rstrip('/')}/odds_history_formatted", mode)
    return formatted
