"""Input that is computed once: bucketed tables, dates from a plainer table, stored input of ranks and averages."""

import datetime as dt
import re
import uuid
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import form, matchup, ranks
from formline.plans import star
from formline.plans.catalog import QUERIES
from formline.scratch import new_folder
from formline.sources.tables import sink_warehouse_table

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="needs the generated tables")


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan):
    return len(re.findall(r"\bExchange hashpartitioning", plan))


def bucketed(spark, df, key, buckets):
    return spark.table(sink_warehouse_table(
        df, "default", "t_" + uuid.uuid4().hex, bucket_by=[key], buckets=buckets, path=new_folder(spark, "bucketed")
    ))


def test_bucketed_tables_join_and_group_without_an_exchange(spark):
    rows = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    left, right = (bucketed(spark, rows.withColumnRenamed("id", n), "k", 4) for n in ("a", "b"))
    joined = left.hint("merge").join(right, "k")
    grouped = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert shuffles(plan_of(joined)[1]) == 0 and shuffles(plan_of(grouped)[1]) == 0
    assert joined.count() == 50 * 20 * 20 and rows_of(grouped) == sorted([(k, 20) for k in range(50)], key=repr)
    assert rows_of(left.select("k", "a")) == rows_of(rows.select("k", F.col("id").alias("a")))


def test_bucketed_table_of_no_rows(spark):
    assert bucketed(spark, spark.range(0).withColumnRenamed("id", "k"), "k", 4).collect() == []


@needs_tables
def test_matchups_scan_the_lines_at_most_twice(spark):
    for name in ("assemble_matchup", "dataset_home_win"):
        logical = plan_of(QUERIES[name](spark, SF))[0]
        assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey|FileScan parquet \[[^\]]*l_suppkey", logical)) <= 2


@needs_tables
def test_dates_of_a_plainer_table_change_no_matchup(spark):
    tables = star.games(spark, SF), star.team_batting(spark, SF), star.individual_pitching(spark, SF)
    own = matchup.assemble_matchup(*tables)
    given = matchup.assemble_matchup(*tables, dates=star.game_dates(spark, SF))
    assert own.columns == given.columns and rows_of(own) == rows_of(given)


@needs_tables
def test_lines_are_stored_once_an_application(spark):
    assert star.order_lines(spark, SF) is star.order_lines(spark, SF)
    assert rows_of(star.order_lines(spark, SF)) == rows_of(star._counted_lines(spark, SF))


def test_derived_input_is_read_back_in_both_passes(spark):
    """The text is parsed when it is stored; neither the sizes nor the ranks parse it again."""
    text = spark.range(200).select(F.format_string('{"k": %d, "v": %d}', F.col("id") % 3, F.col("id") % 17).alias("t"))
    rows = text.select(F.from_json("t", "k int, v int").alias("j")).select("j.*")
    for limit in (1000, 20):
        plain = ranks.rank_within(rows, ["k"], "v", "r", limit=limit)
        derived = ranks.rank_within(rows, ["k"], "v", "r", limit=limit, derived=True)
        assert "from_json" not in plan_of(derived)[0]
        assert rows_of(plain) == rows_of(derived)


def test_averages_of_derived_input(spark):
    start = dt.date(2020, 1, 1)
    spec = form.FormSpec(entity=("team",), measures=("runs",), windows=(1, 3))
    rows = spark.createDataFrame(
        [(f"t{i % 2}", 2020, start + dt.timedelta(i // 3), i, i * 7 % 11) for i in range(90)],
        "team string, season int, officialdate date, id bigint, runs int",
    )
    for limit in (1000, 20):
        assert rows_of(form.trailing_rows(rows, spec, limit=limit)) == rows_of(
            form.trailing_rows(rows, spec, limit=limit, derived=True)
        )
    assert form.trailing_rows(rows.limit(0), spec, derived=True).collect() == []
