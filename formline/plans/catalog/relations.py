"""Aggregations, metrics, set operations, scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from formline.operators import columns, datasets, metrics
from formline.plans import star
from formline.plans.catalog.registry import query
from formline.plans.star import TEST_SEASON, VALIDATION_SEASON
from formline.scratch import new_folder
from formline.sources import csv as csv_source
from formline.sources import tables as table_source

_SPLIT = (
    f"CASE WHEN season < {VALIDATION_SEASON} THEN 'train' WHEN season = {VALIDATION_SEASON} THEN 'validation' "
    f"WHEN season = {TEST_SEASON} THEN 'test' END"
)
RESULT_CTES = {
    "scored": f"SELECT *, {_SPLIT} AS dataset, CASE WHEN (model_prediction > 0.5::DOUBLE) = (HomeTeamWin = 1) THEN 1 ELSE 0 END AS "
    "correct FROM predictions",
    "summary": "SELECT season, game_month, dataset, round(avg(model_prediction), 9) AS avg_model_prediction, count(*) AS games, "
    "CAST(sum(correct) AS BIGINT) AS correct, CAST(season AS VARCHAR) || lpad(CAST(game_month AS VARCHAR), 2, '0') AS yrmo, "
    "CAST(sum(correct) AS DOUBLE) / count(*) AS pct FROM scored GROUP BY season, game_month, dataset",
}


def _scored(spark, sf):
    return metrics.label_predictions(
        datasets.season_split(star.predictions(spark, sf), VALIDATION_SEASON, TEST_SEASON)
    )


@query("result_summary", "SELECT * FROM summary", RESULT_CTES)
def result_summary(spark, sf):
    summary = metrics.result_summary(_scored(spark, sf))
    return summary.withColumn("avg_model_prediction", F.round("avg_model_prediction", 9))


@query(
    "accuracy_rollup",
    "SELECT dataset, CAST(sum(correct) AS DOUBLE) / sum(games) AS pct FROM summary GROUP BY dataset",
    RESULT_CTES,
)
def accuracy_rollup(spark, sf):
    return metrics.accuracy_rollup(metrics.result_summary(_scored(spark, sf)))


_Z = "(pct - 0.55::DOUBLE) / sqrt(0.55::DOUBLE * 0.45::DOUBLE / games)"
# The same series for Phi, folded from its innermost term.
_PHI = (
    "CASE WHEN z >= 8.3 THEN 1.0 WHEN z <= -8.3 THEN 0.0 ELSE 0.5 + exp(-z * z / 2) / sqrt(2 * pi()) * z * "
    "list_reduce(list_prepend(1.0::DOUBLE, list_transform(range(150, 0, -1), lambda k: (z * z / (2 * k + 1))::DOUBLE)), "
    "lambda acc, f: 1.0 + f * acc) END"
)


@query(
    "accuracy_ztest",
    f"SELECT dataset, season, game_month, yrmo, games, correct, pct AS success_rate, round(z, 9) AS z_score, round(p, 9) AS p_value, "
    f"CASE WHEN p < 0.05::DOUBLE THEN 'Yes' ELSE 'No' END AS \"better_than_55%\" FROM (SELECT *, 1 - {_PHI} AS p FROM (SELECT *, {_Z} "
    "AS z FROM summary))",
    RESULT_CTES,
)
def accuracy_ztest(spark, sf):
    tested = metrics.accuracy_ztest(metrics.result_summary(_scored(spark, sf)))
    return tested.withColumns({"z_score": F.round("z_score", 9), "p_value": F.round("p_value", 9)})


_PAIR = "(SELECT CAST(l_linenumber AS DOUBLE) AS y, l_quantity / 10 AS p FROM lineitem)"
_METRIC_SQL = {
    "mae": "avg(abs(y - p))",
    "rmse": "sqrt(avg((y - p) * (y - p)))",
    "mse": "avg((y - p) * (y - p))",
    "msle": "avg(pow(ln(1 + y) - ln(1 + p), 2))",
    "mape": "avg(abs((y - p) / (y + 3)))",
}


def _pairs(spark, sf):
    return star.table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("y"), (F.col("l_quantity") / 10).alias("p"))


def _metric(name: str) -> None:
    @query(f"metric_{name}", f"SELECT round({_METRIC_SQL[name]}, 9) AS {name} FROM {_PAIR}")
    def run(spark, sf):
        return metrics.evaluate(_pairs(spark, sf), [name], "y", "p").select(F.round(name, 9).alias(name))


for _name in _METRIC_SQL:
    _metric(_name)


@query(
    "metric_log_loss",
    "SELECT round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 9) AS log_loss FROM (SELECT HomeTeamWin AS y, "
    "least(greatest(model_prediction, 1e-15::DOUBLE), 1 - 1e-15::DOUBLE) AS p FROM predictions)",
)
def metric_log_loss(spark, sf):
    loss = metrics.evaluate(star.predictions(spark, sf), ["log_loss"], "HomeTeamWin", "model_prediction")
    return loss.select(F.round("log_loss", 9).alias("log_loss"))


_NAIVE = (
    "SELECT avg(abs(y - before)) AS naive FROM (SELECT floor(o_totalprice) AS y, lag(floor(o_totalprice)) OVER (ORDER BY "
    "o_orderdate, o_orderkey) AS before FROM orders)"
)


def _prices(spark, sf):
    return star.table(spark, sf, "orders").withColumn("y", F.floor("o_totalprice"))


@query("naive_forecast_error", f"SELECT round(naive, 6) AS naive_forecast_error FROM ({_NAIVE})")
def naive_forecast_error(spark, sf):
    error = metrics.naive_forecast_error(_prices(spark, sf), "y", ["o_orderdate", "o_orderkey"])
    return error.select(F.round("naive_forecast_error", 6).alias("naive_forecast_error"))


@query(
    "metric_mase",
    f"SELECT round((SELECT avg(abs(floor(o_totalprice) - o_custkey)) FROM orders) / naive, 9) AS mase FROM ({_NAIVE})",
)
def metric_mase(spark, sf):
    rows = _prices(spark, sf)
    return metrics.mase(rows, "y", "o_custkey", rows, "y", ["o_orderdate", "o_orderkey"]).select(F.round("mase", 9).alias("mase"))


@query(
    "row_counts",
    "SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem "
    "UNION ALL SELECT 'games', count(*) FROM games",
)
def row_counts(spark, sf):
    return columns.row_counts({
        "orders": star.table(spark, sf, "orders"), "lineitem": star.table(spark, sf, "lineitem"),
        "games": star.games(spark, sf),
    })


@query("distinct_rows", "SELECT DISTINCT player_name, season, officialdate, strikeouts, runs FROM individual_pitching")
def distinct_rows(spark, sf):
    rows = star.individual_pitching(spark, sf).select("player_name", "season", "officialdate", "strikeouts", "runs")
    return columns.distinct_rows(rows)


_TAGGED = f"(SELECT *, {_SPLIT} AS dataset FROM predictions)"


@query("dedupe_union", f"SELECT DISTINCT * FROM {_TAGGED} WHERE dataset IS NOT NULL")
def dedupe_union(spark, sf):
    """The three splits are values of one column, so their union is a filter and one scan."""
    rows = datasets.season_split(star.predictions(spark, sf), VALIDATION_SEASON, TEST_SEASON)
    return rows.where(F.col("dataset").isNotNull()).dropDuplicates()


@query(
    "union_all_daily",
    "SELECT GamePK, OfficialDate, HomeTeamName, AwayTeamName FROM final_games WHERE OfficialDate BETWEEN DATE '1990-01-01' AND "
    "DATE '2010-12-31'",
)
def union_all_daily(spark, sf):
    """A run of dates in one plan, where day-by-day frames would be united afterwards."""
    dates = F.col("OfficialDate").between(F.lit("1990-01-01").cast("date"), F.lit("2010-12-31").cast("date"))
    return star.final_games(spark, sf).where(dates).select("GamePK", "OfficialDate", "HomeTeamName", "AwayTeamName")


@query(
    "union_by_name",
    "SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier",
)
def union_by_name(spark, sf):
    customers = star.table(spark, sf, "customer").withColumnsRenamed({
        "c_custkey": "key", "c_name": "name", "c_nationkey": "nation", "c_acctbal": "balance", "c_mktsegment": "segment",
    })
    suppliers = star.table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("key"),
    )
    return columns.union_by_name([customers, suppliers])


# --- scans and sinks: Spark writes a given table, the operator reads it -------------------

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
_ORDERS_SQL = "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders"


def _orders(spark, sf):
    return star.table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def _write_csv(df, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


@query("scan_csv", _ORDERS_SQL)
def scan_csv(spark, sf):
    path = new_folder(spark, "scan-csv")
    _write_csv(_orders(spark, sf), path)
    return csv_source.scan_csv(spark, path, ORDERS)


@query("scan_parquet", _ORDERS_SQL)
def scan_parquet(spark, sf):
    return table_source.scan_parquet(spark, f"{sf}/orders.parquet").withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("scan_csv_prefix", _ORDERS_SQL)
def scan_csv_prefix(spark, sf):
    """Parts with other column orders and a stray index column, below one prefix."""
    path = new_folder(spark, "scan-prefix")
    rows = _orders(spark, sf)
    _write_csv(rows.where("o_orderstatus = 'F'"), f"{path}/finished")
    moved = rows.select("o_orderdate", "o_totalprice", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    _write_csv(moved.where("o_orderstatus = 'O'"), f"{path}/open")
    indexed = rows.select(F.monotonically_increasing_id().alias("Unnamed: 0"), "*")
    _write_csv(indexed.where("o_orderstatus = 'P'"), f"{path}/pending")
    return csv_source.scan_csv_prefix(spark, path, ORDERS)


@query("sink_parquet", _ORDERS_SQL + " ")
def sink_parquet(spark, sf):
    """Written twice by partition: the second run replaces the first."""
    path = new_folder(spark, "sink-parquet")
    rows = _orders(spark, sf)
    for _ in range(2):
        table_source.sink_parquet(rows, path, "overwrite", ["o_orderstatus"])
    return table_source.scan_parquet(spark, path).select(*rows.columns)


@query("sink_csv_period", _ORDERS_SQL + "  ")
def sink_csv_period(spark, sf):
    path = new_folder(spark, "sink-csv")
    rows = _orders(spark, sf)
    years = rows.agg(F.year(F.min("o_orderdate")).alias("first"), F.year(F.max("o_orderdate")).alias("last")).first()
    for year in range(years.first, years.last + 1, 2):
        begin, end = f"{year}-01-01", f"{year + 1}-12-31"
        period = rows.where(F.col("o_orderdate").between(F.lit(begin).cast("date"), F.lit(end).cast("date")))
        table_source.sink_csv_period(period, path, "orders", begin, end)
    return csv_source.scan_csv_prefix(spark, f"{path}/orders", ORDERS)


@query("sink_warehouse_table", _ORDERS_SQL)
def sink_warehouse_table(spark, sf):
    database = "formline_" + new_folder(spark, "w").rsplit("-", 1)[1][:12]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database} LOCATION '{new_folder(spark, 'warehouse')}'")
    return spark.table(table_source.sink_warehouse_table(_orders(spark, sf), database, "orders"))
