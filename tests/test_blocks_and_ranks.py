"""Oversized groups give the same answers as one window over the group."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formline.operators import blocks, form, ranks
from formline.operators.blocks import BLOCK, with_blocks


def skewed(spark, n=600, seed=1, spread=40):
    """A third of the rows on one key, NULL keys and values, many ties."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else draw.choice(["a", "b", None, "c"])
        value = None if draw.random() < 0.05 else float(draw.randrange(spread))
        rows.append((key, value, i))
    return spark.createDataFrame(rows, "k string, v double, id int").repartition(5)


def test_blocks_follow_the_order_and_keep_all_rows(spark):
    df = skewed(spark)
    placed, cut = with_blocks(df, ["k"], ["v", "id"], limit=20)
    assert cut and placed.count() == 600
    got = placed.collect()
    sizes = {}
    for key in {r.k for r in got}:
        mine = sorted((r for r in got if r.k == key), key=lambda r: (r.v is not None, r.v or 0.0, r.id))
        numbers = [r[BLOCK] for r in mine]
        assert numbers == sorted(numbers)
        for b in numbers:
            sizes[key, b] = sizes.get((key, b), 0) + 1
    assert len({b for k, b in sizes if k == "hot"}) > 3
    assert max(sizes.values()) < 200


def test_rows_tied_in_the_order_are_cut_by_number(spark, monkeypatch):
    """1,000 copies of one row, 500 that differ elsewhere, ties at NULL, and ordinary rows around them."""
    monkeypatch.setattr(blocks, "COPIES_AT_ONCE", 7)
    rows = [("hot", 5.0, 1)] * 1000 + [("hot", 7.0, i) for i in range(500)] + [("hot", None, 3)] * 90
    rows += [("hot", float(i % 12) + 0.5, i) for i in range(120)] + [(None, 1.0, 1)] * 300 + [("b", 1.0, 1)] * 5
    df = spark.createDataFrame(rows, "k string, v double, id int").repartition(6)
    placed, cut = with_blocks(df, ["k"], ["v"], limit=20)
    assert cut and rows_of(placed.drop(BLOCK)) == rows_of(df)
    sizes = {}
    for r in placed.collect():
        sizes.setdefault((r.k, r.v), {}).setdefault(r[BLOCK], []).append(r.id)
    for (key, value), of in sizes.items():
        assert max(map(len, of.values())) <= 20, (key, value)
    assert len(sizes["hot", 5.0]) == 50 and len(sizes["hot", None]) == 5 and len(sizes[None, 1.0]) == 15 and len(sizes["b", 1.0]) == 1
    # Blocks follow the order, and a block of tied rows holds no others.
    by_value = sorted(((v is not None, v or 0.0), min(of), max(of)) for (k, v), of in sizes.items() if k == "hot")
    for (_, _, high), (_, low, _) in zip(by_value, by_value[1:], strict=False):
        assert high <= low
    tied = {b for v in (5.0, 7.0, None) for b in sizes["hot", v]}
    assert not tied & {b for (k, v), of in sizes.items() if k == "hot" and v not in (5.0, 7.0, None) for b in of}
    assert rows_of(with_blocks(df.repartition(3), ["k"], ["v"], limit=20)[0]) == rows_of(placed)


def test_trailing_averages_over_tied_rows_are_those_of_one_window(spark):
    spec = form.FormSpec(entity=("k",), measures=("v",), windows=(1, 3, 7))
    rows = [("hot", 2024, f"2024-04-{1 + i // 400:02d}", 1, float(i // 400)) for i in range(1600)]
    rows += [("hot", 2024, "2024-04-02", 1, 9.0), ("hot", 2024, "2024-04-03", 0, 4.0), ("cold", 2024, "2024-04-01", 1, 1.0)]
    df = spark.createDataFrame(rows, "k string, season int, officialdate string, id int, v double").repartition(4)
    cut = form.trailing_rows(df, spec, counts=True, limit=20)
    whole = form.trailing_rows(df, spec, counts=True, limit=1_000_000)
    assert rows_of(cut, whole.columns) == rows_of(whole, whole.columns)


def test_blocks_are_a_function_of_values(spark):
    df = skewed(spark)
    one = rows_of(with_blocks(df, ["k"], ["v", "id"], limit=20)[0])
    two = rows_of(with_blocks(df.repartition(3), ["k"], ["v", "id"], limit=20)[0])
    assert one == two


def test_ordinary_groups_are_not_cut(spark):
    placed, cut = with_blocks(skewed(spark), ["k"], ["v", "id"], limit=1000)
    assert not cut and {r[0] for r in placed.select(BLOCK).distinct().collect()} == {0}


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("spread", [3, 40, 5000])
def test_rank_of_oversized_groups_equals_the_window(spark, ascending, spread):
    df = skewed(spark, seed=spread, spread=spread)
    order = F.asc_nulls_last("v") if ascending else F.desc_nulls_last("v")
    expected = df.withColumn("r", F.rank().over(W.partitionBy("k").orderBy(order)))
    got = ranks.rank_within(df, ["k"], "v", "r", ascending, limit=20)
    assert rows_of(got, ["k", "v", "id", "r"]) == rows_of(expected, ["k", "v", "id", "r"])


def test_stacked_ranks_equal_window_ranks(spark):
    df = skewed(spark).withColumn("w", F.col("id") % 7)
    one = ranks.ranks_by_window(df, ["k"], ["v", "w"])
    two = ranks.ranks_by_stacking(df, ["k"], ["id"], ["v", "w"], limit=20)
    assert rows_of(one) == rows_of(two)
