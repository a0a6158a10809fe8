"""Averages from running sums and ranks from range partitions equal the windows they replace."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from scales import SF_SMALL

from ohlcflow import queries as Q
from ohlcflow.operators.features import add_moving_averages, add_volume_spike_flag
from ohlcflow.operators.marts import top_movers
from ohlcflow.plans.ranks import value_ranks
from ohlcflow.plans.sums import prefix_trailing_avg


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("segmented", [False, True])
def test_prefix_equals_sliding_frames(spark, segmented):
    bars = Q.clean_bars(spark, SF_SMALL)
    windows = [1, 2, 7, 30, 90]
    got = add_moving_averages(bars, windows, frames="prefix", segmented=segmented, block_rows=89)
    assert got.columns == add_moving_averages(bars, windows).columns
    assert _same(got, add_moving_averages(bars, windows))
    got = add_volume_spike_flag(bars, frames="prefix", segmented=segmented, block_rows=40)
    assert _same(got, add_volume_spike_flag(bars))


def test_null_values_and_keys(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["A", None]), i, rng.choice([None, None, i / 64])) for i in range(300)] + [("N", 1, None)]
    df = spark.createDataFrame(rows, "k string, d int, v double")
    for n, block in ((1, 1), (3, 2), (5, 7), (400, 400)):
        w = Window.partitionBy("k").orderBy("d").rowsBetween(1 - n, 0)
        assert _same(prefix_trailing_avg(df, {"a": ("v", n)}, "k", "d", block), df.withColumn("a", F.avg("v").over(w)))
    with pytest.raises(ValueError):
        prefix_trailing_avg(df, {"a": ("v", 5)}, "k", "d", 3)
    assert prefix_trailing_avg(df.where("k = 'none'"), {"a": ("v", 5)}, "k", "d").count() == 0


def test_error_bound_for_values_off_the_grid(spark):
    rng, block, n = random.Random(3), 64, 7
    values = [rng.uniform(-1e6, 1e6) if i % 9 else rng.uniform(-1e-3, 1e-3) for i in range(500)]
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate(values)], "k string, d int, v double")
    got = {r.d: r.a for r in prefix_trailing_avg(df, {"a": ("v", n)}, "k", "d", block).collect()}
    bound_of = lambda i: 2 * (block + n) * 2.0**-53 * sum(abs(v) for v in values[max(0, i - block - n) : i + 1]) / min(n, i + 1)
    for i in range(500):
        frame = values[max(0, i - n + 1) : i + 1]
        assert abs(got[i] - math.fsum(frame) / len(frame)) <= bound_of(i)


def test_all_frames_share_one_exchange(spark):
    bars = spark.range(100).selectExpr("string(id % 3) as symbol", "id as date", "id * 1.0D as close", "id as volume")
    df = add_moving_averages(bars, [7, 30, 90], frames="prefix")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    # running sums start at the block's first row; no frame is added up again
    assert "specifiedwindowframe(RowFrame, -89" not in plan and "specifiedwindowframe(RowFrame, -6" not in plan
    assert plan.count("unboundedpreceding$(), currentrow$()") >= 1


def test_value_ranks_of_a_hot_group(spark):
    rng = random.Random(4)
    rows = [("hot", rng.choice([None, float("nan"), 0.0, -0.0, rng.uniform(-5, 5), float(rng.randrange(50))])) for _ in range(3000)]
    rows += [(rng.choice(["a", "b", None]), float(rng.randrange(20))) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v double")
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    want = df.select("g", "v", F.dense_rank().over(w).alias("rank")).distinct()
    got = value_ranks(df, ["g"], "v", partitions=8)
    assert _same(got, want)
    assert value_ranks(df.where("g = 'none'"), ["g"], "v").count() == 0


def test_ranking_cuts_the_hot_date_into_ranges(spark):
    df = spark.range(4000).selectExpr("date'2024-01-01' as date", "id / 7.0D as abs_return")
    from ohlcflow.plans.ranks import descending_key

    ranged = df.select(F.struct("date").alias("g"), descending_key("abs_return").alias("o")).repartitionByRange(8, "g", "o")
    assert ranged.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 1000
    ranks = value_ranks(df, ["date"], "abs_return", partitions=8)
    assert ranks.agg(F.max("rank")).first()[0] == 4000


def test_movers_by_range_equal_the_window(spark):
    silver = Q.clean_silver(spark, SF_SMALL)
    for n in (1, 3):
        assert _same(top_movers(silver, n, ties="range"), top_movers(silver, n))
    assert top_movers(silver, 1).count() < silver.filter(~F.col("price_spike_flag")).count()
    tied = silver.withColumn("daily_return_pct", F.round("daily_return_pct"))
    assert _same(top_movers(tied, 2, ties="range"), top_movers(tied, 2))
    with pytest.raises(ValueError):
        top_movers(silver, ties="none")
