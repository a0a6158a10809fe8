"""Segmented (block + halo) windows equal the direct window, also for one hot key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from scales import SF_SMALL
from ohlcflow import queries as Q
from ohlcflow.operators.features import add_moving_averages, add_volume_spike_flag
from ohlcflow.plans.skew import segmented_trailing_avg, series_row_number


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_row_numbers_are_exact(spark):
    bars = Q.clean_bars(spark, SF_SMALL)
    got = series_row_number(bars).select("symbol", "date", "_rn")
    want = bars.select(
        "symbol", "date", F.row_number().over(Window.partitionBy("symbol").orderBy("date")).alias("_rn")
    )
    assert _same(got, want)


def test_segmented_equals_direct(spark):
    bars = Q.clean_bars(spark, SF_SMALL)
    for block in (29, 64, 1000):
        a = add_moving_averages(bars, [1, 7, 30, 90], segmented=True, block_rows=max(block, 89))
        assert _same(a, add_moving_averages(bars, [1, 7, 30, 90]))
        v = add_volume_spike_flag(bars, segmented=True, block_rows=block)
        assert _same(v, add_volume_spike_flag(bars))


def test_one_hot_key(spark):
    # all bars in one series (a third of all rows and more): ties on date are
    # ordered by the original symbol in both forms
    bars = Q.clean_bars(spark, SF_SMALL).withColumn("k", F.lit("HOT"))
    seg = segmented_trailing_avg(
        bars, {"a30": ("close", 30)}, key="k", order="date", tiebreak=["symbol"], block_rows=500
    )
    w = Window.partitionBy("k").orderBy("date", "symbol").rowsBetween(-29, 0)
    direct = bars.withColumn("a30", F.avg("close").over(w))
    assert _same(seg, direct)
    # the block windows are keyed by (key, block): many partitions, not one
    plan = seg._jdf.queryExecution().executedPlan().toString()
    assert "_blk" in plan


def test_null_keys_and_dates(spark, raw_bars):
    from ohlcflow.operators.clean import cast_schema
    rows = [(s, d, "1", "2", "1", c, "1") for s, d, c in [
        (None, "2021-01-01", "1"), (None, "2021-01-02", "2"), ("A", None, "3"), ("A", "2021-01-01", "4"),
        ("A", "2021-01-02", "5"), ("A", "2021-01-03", "6"),
    ]]
    df = cast_schema(raw_bars(rows))
    assert _same(add_moving_averages(df, [2], segmented=True, block_rows=2), add_moving_averages(df, [2]))


def test_auto_mode(spark):
    from ohlcflow.plans import skew

    bars = Q.clean_bars(spark, SF_SMALL)
    assert skew.longest_series(bars) == bars.groupBy("symbol").count().agg(F.max("count")).first()[0]
    assert not skew.should_segment("auto", bars)
    assert skew.should_segment("auto", bars, hot_rows=10)
    assert _same(add_moving_averages(bars, [7], segmented="auto"), add_moving_averages(bars, [7]))


def test_marts_segmented_pass_through(spark):
    from ohlcflow.operators.marts import stock_summary, volume_analysis

    s = Q.clean_silver(spark, SF_SMALL)
    assert _same(stock_summary(s, segmented=True), stock_summary(s))
    assert _same(volume_analysis(s, segmented="auto"), volume_analysis(s))


def test_segmented_queries_store_the_columns_they_need(spark, monkeypatch):
    from ohlcflow.plans import skew

    seen, own = [], skew.series_row_number
    monkeypatch.setattr(skew, "series_row_number", lambda df, *a, **k: seen.append(df.columns) or own(df, *a, **k))
    averages = Q.q_moving_average_segmented(spark, SF_SMALL)
    volumes = Q.q_volume_spike_segmented(spark, SF_SMALL)
    assert seen == [["symbol", "date", "close"], ["symbol", "date", "volume"]]
    assert _same(averages, Q.q_moving_average(spark, SF_SMALL)) and _same(volumes, Q.q_volume_spike(spark, SF_SMALL))
