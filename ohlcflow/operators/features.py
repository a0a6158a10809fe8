"""Per-bar derived columns and per-symbol rolling windows.

Rolling windows are ``ROWS`` frames: an n-row average covers the current row
and the n-1 rows before it in date order, and is partial (fewer rows) at the
start of a series. All averages requested together share one window
specification, so Spark evaluates them in a single ``Window`` operator after a
single shuffle on ``symbol``.

Group size: after deduplication on (symbol, date) a symbol has at most one
row per calendar day, so a window partition is bounded by the length of the
date range, not by the size of the data set; more data means more symbols,
i.e. more partitions. For inputs that are not unique on (symbol, date), use
:func:`ohlcflow.plans.skew.segmented_trailing_avg` (``segmented=True``), which splits a hot
symbol into row blocks with halo rows and gives identical results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import daily_return, price_range, price_spike, strictly_above
from ..schemas import MA_WINDOWS, MAX_PRICE_SPIKE, VOLUME_SPIKE_MULTIPLIER, VOLUME_WINDOW, ma_column


def series_window(n: int, key: str = "symbol", order: str = "date"):
    """The n-row trailing frame of one series (current row included)."""
    if n < 1:
        raise ValueError(f"window must be >= 1 row, got {n}")
    return Window.partitionBy(key).orderBy(F.col(order).asc()).rowsBetween(1 - n, 0)


def add_daily_return(df: DataFrame) -> DataFrame:
    """``daily_return_pct = round((close - open) / open * 100, 4)``."""
    return df.withColumn("daily_return_pct", daily_return())


def add_price_range(df: DataFrame) -> DataFrame:
    """``price_range = round(high - low, 4)``."""
    return df.withColumn("price_range", price_range())


def add_price_spike_flag(df: DataFrame, max_pct: float = MAX_PRICE_SPIKE) -> DataFrame:
    """True when ``|daily_return_pct| > max_pct * 100`` (strict; NULL -> false)."""
    return df.withColumn("price_spike_flag", price_spike("daily_return_pct", max_pct))


def add_moving_averages(
    df: DataFrame,
    windows: Sequence[int] = MA_WINDOWS,
    value: str = "close",
    segmented: bool | str = False,
    block_rows: int | None = None,
    frames: str = "sliding",
) -> DataFrame:
    """Add ``ma_{n}d = round(avg(value) over the n-row frame, 4)`` per window.

    ``segmented=True`` evaluates the same frames with the block + halo plan
    of :mod:`ohlcflow.plans.skew` (for series too large for one task);
    ``"auto"`` measures the longest series first (one small job) and segments
    only when it exceeds ``plans.skew.DEFAULT_HOT_ROWS``. ``frames="prefix"``
    takes the averages from running sums (:mod:`ohlcflow.plans.sums`): constant
    work a row, whatever the windows.
    """
    from ..plans.skew import DEFAULT_BLOCK_ROWS, segmented_trailing_avg, should_segment

    segment = should_segment(segmented, df)
    if _by_running_sums(frames):
        raw = {f"_raw_{n}": (value, n) for n in windows}
        out = _prefix_avg(df, raw, segment, block_rows)
        return out.withColumns({ma_column(n): F.round(F.col(f"_raw_{n}"), 4) for n in windows}).drop(*raw)
    if segment:
        raw = {f"_raw_{n}": (value, n) for n in windows}
        out = segmented_trailing_avg(df, raw, block_rows=block_rows or DEFAULT_BLOCK_ROWS)
        return out.withColumns(
            {ma_column(n): F.round(F.col(f"_raw_{n}"), 4) for n in windows}
        ).drop(*raw)
    return df.withColumns(
        {ma_column(n): F.round(F.avg(value).over(series_window(n)), 4) for n in windows}
    )


def _by_running_sums(frames: str) -> bool:
    if frames not in ("sliding", "prefix"):
        raise ValueError(f"frames must be 'sliding' or 'prefix', got {frames!r}")
    return frames == "prefix"


def _prefix_avg(df: DataFrame, specs: dict, segment: bool, block_rows: int | None) -> DataFrame:
    from ..plans.sums import DEFAULT_SUM_ROWS, prefix_trailing_avg

    return prefix_trailing_avg(df, specs, block_rows=block_rows or DEFAULT_SUM_ROWS, segmented=segment)


def add_moving_average(df: DataFrame, window_days: int) -> DataFrame:
    return add_moving_averages(df, [window_days])


def add_volume_spike_flag(
    df: DataFrame,
    window: int = VOLUME_WINDOW,
    multiplier: float = VOLUME_SPIKE_MULTIPLIER,
    segmented: bool | str = False,
    block_rows: int | None = None,
    frames: str = "sliding",
) -> DataFrame:
    """``avg_30d_volume`` (unrounded) and ``volume_spike = volume > 2 * avg``.

    The frame includes the current row, so with volume >= 0 the first two
    rows of a series can never spike. ``segmented`` and ``frames`` as in
    :func:`add_moving_averages`.
    """
    from ..plans.skew import DEFAULT_BLOCK_ROWS, segmented_trailing_avg, should_segment

    avg_col = f"avg_{window}d_volume"
    segment = should_segment(segmented, df)
    if _by_running_sums(frames):
        df = _prefix_avg(df, {avg_col: ("volume", window)}, segment, block_rows)
    elif segment:
        df = segmented_trailing_avg(
            df, {avg_col: ("volume", window)}, block_rows=block_rows or DEFAULT_BLOCK_ROWS
        )
    else:
        df = df.withColumn(avg_col, F.avg("volume").over(series_window(window)))
    return df.withColumn(
        "volume_spike", strictly_above("volume", F.col(avg_col) * F.lit(multiplier))
    )
