"""The transformation functions are called the way existing callers call them:
same names, positional arguments, raw string bars in."""

from pyspark.sql import functions as F

from ohlcflow.operators import (
    add_daily_return,
    add_moving_average,
    add_price_range,
    add_price_spike_flag,
    add_volume_spike_flag,
    cast_schema,
    deduplicate,
    filter_valid_prices,
)


def test_chain_of_calls(sample_bars, dirty_sample):
    typed = cast_schema(sample_bars)
    enriched = add_price_spike_flag(add_price_range(add_daily_return(typed)), 0.50)
    assert {"daily_return_pct", "price_range", "price_spike_flag"} <= set(enriched.columns)
    row = enriched.filter((F.col("symbol") == "NORD") & (F.col("date") == "2022-05-03")).first()
    assert row["daily_return_pct"] == 1.0
    assert row["price_range"] == 2.0
    assert enriched.filter("price_spike_flag").count() == 0
    ma = add_moving_average(typed, 3)
    assert "ma_3d" in ma.columns and ma.filter(F.col("ma_3d").isNull()).count() == 0
    assert ma.select("symbol").distinct().count() == 2
    vol = add_volume_spike_flag(typed)
    assert {"avg_30d_volume", "volume_spike"} <= set(vol.columns)
    cleaned = deduplicate(filter_valid_prices(cast_schema(dirty_sample)), ["symbol", "date"])
    assert cleaned.count() == 2  # the good row once, and the NULL-symbol row
    assert cleaned.filter(F.col("symbol").isNull()).count() == 1
