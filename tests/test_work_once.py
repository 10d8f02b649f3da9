"""Work that is done once, and documents that are built by tasks of bounded size."""

from collections import Counter
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import datasets, odds
from formline.plans import jobs, star
from formline.plans.catalog import QUERIES, models, nested

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="needs the generated tables")


def test_runs_by_side_compute_their_matchups_once(spark):
    names = datasets.reporting_fields()
    kinds = {"VenueName": "string", "OfficialDate": "date"}
    passed = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(value):
        passed.add(1)
        return value

    rows = spark.range(0, 20, 1, 2).select(*[
        F.lit("2024-04-02").cast("date").alias(n) if n.lower().endswith("officialdate")
        else seen(F.col("id").cast("int")).alias(n) if n == "HomeRuns" else (F.col("id") + i).cast(kinds.get(n, "int")).alias(n)
        for i, n in enumerate(names)
    ])
    plain = datasets.dataset_runs_by_side(rows.withColumn("HomeRuns", F.col("HomeRuns").cast("int")))
    expected = [rows_of(side) for side in plain]
    before = passed.value
    stored = datasets.dataset_runs_by_side(rows, derived=True)
    once = passed.value - before
    assert [rows_of(side) for side in stored] == expected and [s.columns for s in stored] == [p.columns for p in plain]
    assert once > 0 and passed.value - before == once


@needs_tables
def test_both_batches_hold_the_features_computed_once(spark, monkeypatch):
    labels, written = Counter(), []
    keep, sink = models.kept, models.sink_parquet
    monkeypatch.setattr(models, "kept", lambda df, label: (labels.update([label]), keep(df, label))[1])
    monkeypatch.setattr(models, "sink_parquet", lambda df, *a: (written.append(df), sink(df, *a))[1])
    assert QUERIES["assemble"](spark, SF).columns[0] in ("GamePK", "use")
    assert labels == {"features": 1} and len(written) == 2
    assert all("Join" not in df._jdf.queryExecution().optimizedPlan().toString() for df in written)


def test_a_season_of_a_stored_tree_is_read_alone(spark):
    rows = spark.range(0, 90, 1, 2).select((F.col("id") % 3 + 2000).cast("int").alias("Season"), "id")
    stored = nested._by_season(rows, 3, "tree")
    assert rows_of(stored) == rows_of(rows)
    one = stored.where(F.col("season") == 2001)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Season" in plan and rows_of(one) == rows_of(rows.where("Season = 2001"))


@needs_tables
@pytest.mark.parametrize("build", [star.game_documents, star.odds_events])
def test_documents_are_built_by_tasks_of_bounded_size(spark, monkeypatch, build):
    whole = build(spark, SF).select(F.to_json(F.struct("*")).alias("text"))
    expected = rows_of(whole)
    monkeypatch.setattr(star, "DOCUMENTS_PER_TASK", 100)
    dealt = build(spark, SF)
    parts = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) == -(-len(expected) // 100) and max(parts) < 200
    assert rows_of(dealt.select(F.to_json(F.struct("*")).alias("text"))) == expected


@needs_tables
def test_prices_are_picked_by_tasks_of_bounded_size(spark, monkeypatch):
    expected = rows_of(QUERIES["format_odds"](spark, SF))
    dealt, deal = [], odds.parse_odds_event
    monkeypatch.setattr(jobs, "SNAPSHOTS_PER_TASK", 100)
    monkeypatch.setattr(odds, "parse_odds_event", lambda df, *a: (dealt.append(df), deal(df, *a))[1])
    assert rows_of(QUERIES["format_odds"](spark, SF)) == expected
    parts = [r["count"] for r in dealt[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) == -(-sum(parts) // 100) > 1 and max(parts) < 200
