"""Tables that are read, written and kept whole, on less disk."""

import gzip
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_disk import landed, size

from formline.operators.form import latest_rows
from formline.plans import jobs, star
from formline.plans.catalog import QUERIES, nested
from formline.scratch import compressed
from formline.sources import documents

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="needs the generated tables")


@needs_tables
def test_snapshot_tables_converts_all_five_tables(spark, monkeypatch):
    made = landed(monkeypatch, nested)
    counts = {r.table_name: r["count"] for r in QUERIES["snapshot_tables"](spark, SF).groupBy("table_name").count().collect()}
    games = star.game_documents(spark, SF).count()
    assert {p.name for p in Path(made["parquet"]).iterdir()} == set(counts)
    assert set(counts) == {"games_history", "team_batting", "team_pitching", "individual_batting", "individual_pitching"}
    assert counts["games_history"] == games and counts["team_batting"] == counts["team_pitching"] == 2 * games
    assert counts["individual_batting"] > counts["individual_pitching"] > 2 * games


@needs_tables
def test_a_stored_tree_is_a_fraction_of_its_text(spark, monkeypatch):
    made = landed(monkeypatch, nested)
    rows = QUERIES["scan_year_category_tree"](spark, SF)
    text = rows.select(F.sum(F.length(F.to_csv(F.struct("*"))))).first()[0]
    files = [p for p in Path(made["scan-tree"]).rglob("part-*")]
    # Its rows have many more columns than the few that the query returns.
    assert files and all(p.name.endswith(".csv.gz") for p in files) and size(made["scan-tree"]) < text / 2


@pytest.fixture
def batches(spark):
    """Games in the newest batch, in an older one, in none, twice in one batch, and without a key."""
    rows = [
        (1, "b", 10), (1, "a", 11), (2, "a", 20), (3, None, 30), (3, None, 31), (4, "b", 41), (4, "b", 40), (4, "a", 49),
        (5, "a", 50), (5, "a", 51), (5, None, 59), (None, "b", 60), (None, "b", 61), (None, "a", 69), (6, "b", 70), (7, "b", 71),
    ]
    return spark.createDataFrame(rows, "GamePK bigint, batch string, x int")


@pytest.mark.parametrize("most", [1_000_000, 2])
def test_the_newest_batch_of_each_game_stays(batches, monkeypatch, most):
    monkeypatch.setattr(jobs, "BROADCAST_GAMES", most)
    expected = rows_of(latest_rows(batches, ["GamePK"], ["batch", "x"]))
    assert len(expected) == 8 and rows_of(jobs.latest_batch(batches)) == expected
    stamped = batches.withColumn("batch", F.when(F.col("batch") == "a", F.lit("2024-01-01 06:00:00")).when(F.col("batch") == "b", F.lit("2024-01-01 09:00:00")))
    for kind in ("timestamp", "timestamp_ntz", "date"):
        typed = stamped.withColumn("batch", F.col("batch").cast(kind))
        assert rows_of(jobs.latest_batch(typed)) == rows_of(latest_rows(typed, ["GamePK"], ["batch", "x"]))
    none = batches.withColumn("batch", F.lit(None).cast("timestamp"))
    assert rows_of(jobs.latest_batch(none)) == rows_of(latest_rows(none, ["GamePK"], ["batch", "x"]))
    assert jobs.latest_batch(batches.limit(0)).count() == 0


def test_games_with_one_row_in_the_newest_batch_are_not_shuffled(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").alias("GamePK"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("batch"), F.rand().alias("x"))
    rows.write.parquet(str(tmp_path / "t"))
    found = jobs.latest_batch(spark.read.parquet(str(tmp_path / "t")))
    assert rows_of(found.select("GamePK", "batch")) == [(i, "b") for i in sorted(range(2000), key=lambda i: repr((i, "b")))]
    union = found._jdf.queryExecution().optimizedPlan()
    assert union.nodeName() == "Union"
    plain, sorted_ = (union.children().apply(i).toString() for i in range(2))
    assert "Join LeftAnti" in plain and "Window [" not in plain
    assert "Window [" in sorted_ and "Join LeftSemi" in sorted_


@needs_tables
def test_a_stored_parse_goes_once_its_tables_are_written(spark, monkeypatch):
    """It lay beside the tables made of it until the end, and the snapshot's came on top."""
    made, parsed = landed(monkeypatch, nested), landed(monkeypatch, documents)
    assert QUERIES["snapshot"](spark, SF).count() > 0
    assert size(made["landing"]) and size(made["flat"]) and parsed.keys() == {"games"}
    assert not Path(parsed["games"]).exists()


def test_landing_files_are_written_at_the_fastest_level(spark, tmp_path):
    """Its size tells the level of a file."""
    rows = spark.range(0, 20_000, 1, 1).select(F.concat_ws(",", *[F.format_string("%d", (F.col("id") * k) % 997) for k in range(1, 30)]).alias("value"))
    compressed(rows).text(str(tmp_path / "lines"))
    (file,) = (tmp_path / "lines").glob("*.gz")
    text = gzip.decompress(file.read_bytes())
    fast, usual = (len(gzip.compress(text, level)) for level in (1, 6))
    assert abs(file.stat().st_size - fast) < abs(file.stat().st_size - usual)
    assert spark.read.text(str(tmp_path / "lines")).count() == 20_000
