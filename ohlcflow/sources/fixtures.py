"""Bar inputs derived from the shared test tables.

``bars_from_ticks`` turns ``lineitem`` rows (ticks) into daily OHLCV bars, one
symbol per supplier (bars grow with the data), with prices on a 1/64 grid so that every window sum is exact and
independent of summation order. ``dirty_bars`` renders those bars as raw
strings and injects one defect class per row, chosen by a hash of the row,
the same way in Spark and in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values of the fixture specification -----------------------------
SYMBOL_FORMAT = "S%02d"    # symbols S00, S01, ... from l_suppkey
PRICE_BASE = 100          # price = 100 + floor(l_extendedprice / 2000 * 64) / 64
PRICE_SCALE = 2000
PRICE_GRID = 64
DEFECT_MODULUS = 97       # k = (dayofyear(date) * 7 + volume) % 97
DEFECT_DAY_FACTOR = 7
# k -> defect: 0 duplicate row, 1 open prefixed with '-', 2 high = low - 1,
# 3 NULL symbol, 4 date 'not-a-date', 5 volume '', 6 close 'n/a'
BAD_DATE = "not-a-date"
BAD_NUMBER = "n/a"
# ---------------------------------------------------------------------------


def tick_price() -> Column:
    return F.lit(PRICE_BASE) + F.floor(
        F.col("l_extendedprice") / PRICE_SCALE * PRICE_GRID
    ) / PRICE_GRID


def bars_from_ticks(lineitem: DataFrame) -> DataFrame:
    """Daily OHLCV bars: one row per (symbol, ship date).

    open/close are the prices of the first/last tick by (l_orderkey,
    l_linenumber, l_suppkey, l_extendedprice, l_quantity); high/low the
    extremes; volume the summed quantity. A partial/final aggregate: each
    task combines its ticks before the shuffle on the bar key.
    """
    order = F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    # Group on the integer symbol id (cheaper sort and shuffle key than the
    # text symbol, which is built once per bar after the aggregation).
    bars = (
        lineitem.select(
            F.col("l_suppkey").alias("_sid"),
            F.col("l_shipdate").cast("date").alias("date"),
            tick_price().alias("price"),
            order.alias("ord"),
            F.col("l_quantity"),
        )
        .groupBy("_sid", "date")
        .agg(
            F.min_by("price", "ord").cast("double").alias("open"),
            F.max("price").cast("double").alias("high"),
            F.min("price").cast("double").alias("low"),
            F.max_by("price", "ord").cast("double").alias("close"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
    )
    symbol = F.format_string(SYMBOL_FORMAT, "_sid")
    return bars.select(symbol.alias("symbol"), "date", "open", "high", "low", "close", "volume")


def dirty_bars(bars: DataFrame) -> DataFrame:
    """Raw all-string bars with injected defects (see module constants)."""
    k = (F.dayofyear("date") * DEFECT_DAY_FACTOR + F.col("volume")) % DEFECT_MODULUS
    raw = bars.select(
        "symbol",
        F.col("date").cast("string").alias("date"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.col("low").alias("_low"),
        k.alias("_k"),
    )

    def when_k(n: int, bad: Column, good: str) -> Column:
        return F.when(F.col("_k") == n, bad).otherwise(F.col(good)).alias(good)

    # k = 0 rows carry no defect and are emitted twice (the exact duplicate),
    # in the same pass: no second scan/aggregation of the bars.
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_k") == 0, 2).otherwise(1)))
    return raw.select("*", copies.alias("_copy")).select(
        when_k(3, F.lit(None).cast("string"), "symbol"),
        when_k(4, F.lit(BAD_DATE), "date"),
        when_k(1, F.concat(F.lit("-"), F.col("open")), "open"),
        when_k(2, (F.col("_low") - 1).cast("string"), "high"),
        "low",
        when_k(6, F.lit(BAD_NUMBER), "close"),
        when_k(5, F.lit(""), "volume"),
    )
