"""Moving-average series, crossover state and the small analytical reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import crossover_signal
from ..schemas import NEUTRAL, REPORT_TOP_K, ma_column
from .features import add_moving_averages


def _for_symbol(df: DataFrame, symbol: str | None) -> DataFrame:
    # An equality filter on the partition column of a symbol-partitioned
    # table becomes a PartitionFilter: only that symbol's files are read.
    return df if symbol is None else df.filter(F.col("symbol") == F.lit(symbol))


def _series_input(df: DataFrame, symbol: str | None, ordered: bool) -> DataFrame:
    """(symbol, date, close), range-partitioned by symbol when the output is
    ordered: the one exchange then serves both the per-symbol window and the
    final ``ORDER BY symbol, date`` (no second shuffle for the sort)."""
    out = _for_symbol(df, symbol).select("symbol", "date", "close")
    return out.repartitionByRange("symbol") if ordered else out


def sma(
    df: DataFrame,
    window: int,
    symbol: str | None = None,
    ordered: bool = True,
    segmented: bool | str = False,
) -> DataFrame:
    """(symbol, date, close, ma_{n}d) for every symbol, or one when given."""
    col = ma_column(window)
    out = add_moving_averages(_series_input(df, symbol, ordered), [window], segmented=segmented)
    out = out.select("symbol", "date", "close", col)
    return out.orderBy("symbol", "date") if ordered else out


def crossover(
    df: DataFrame,
    fast: int = 7,
    slow: int = 30,
    symbol: str | None = None,
    ordered: bool = True,
    segmented: bool | str = False,
) -> DataFrame:
    """Fast/slow average state per bar in one window pass.

    GOLDEN CROSS when the fast average is above the slow one, DEATH CROSS when
    below, NEUTRAL otherwise. Rows with a NULL symbol or date are left out after
    the averages, as the join form (:func:`crossover_join`) does; equal to it
    whenever (symbol, date) is unique, without its extra shuffles.
    """
    f, s = ma_column(fast), ma_column(slow)
    out = add_moving_averages(
        _series_input(df, symbol, ordered), [fast, slow], segmented=segmented
    )
    out = out.filter("symbol is not null and date is not null").select(
        "symbol", "date", "close", f, s, crossover_signal(f, s).alias("crossover_signal")
    )
    return out.orderBy("symbol", "date") if ordered else out


def crossover_join(
    df: DataFrame, fast: int = 7, slow: int = 30, symbol: str | None = None, ordered: bool = True
) -> DataFrame:
    """The reference formulation: inner equi-join of the two average series.

    Rows with a NULL symbol or date drop out of the join.
    """
    f, s = ma_column(fast), ma_column(slow)
    a = sma(df, fast, symbol, ordered=False)
    b = sma(df, slow, symbol, ordered=False).select("symbol", "date", s)
    out = a.join(b, ["symbol", "date"], "inner").select(
        "symbol", "date", "close", f, s, crossover_signal(f, s).alias("crossover_signal")
    )
    return out.orderBy("symbol", "date") if ordered else out


def crossover_edges(
    df: DataFrame,
    fast: int = 7,
    slow: int = 30,
    symbol: str | None = None,
    ordered: bool = True,
    segmented: bool | str = False,
    block_rows: int | None = None,
) -> DataFrame:
    """The bars at which the averages cross: GOLDEN CROSS where the last decided
    state before was DEATH CROSS, and the other way round (``previous_signal``).

    NEUTRAL bars decide nothing, so the state before may lie any number of rows
    back. ``segmented`` splits a series into blocks of ``block_rows``: inside a
    block the state is carried along its rows, and the last state of every
    block, one row each, is carried on to the next ones; no task holds a series.
    """
    from ..plans.skew import should_segment
    from ..plans.sums import DEFAULT_SUM_ROWS, prefix_trailing_avg

    f, s = ma_column(fast), ma_column(slow)
    bars = _for_symbol(df, symbol).select("symbol", "date", "close")
    raw = {"_fast": ("close", fast), "_slow": ("close", slow)}
    segment = should_segment(segmented, bars)
    rows = block_rows or DEFAULT_SUM_ROWS
    numbered = prefix_trailing_avg(bars, raw, block_rows=rows, segmented=segment, keep_number=True)
    numbered = numbered.filter("symbol is not null and date is not null").withColumns({f: F.round("_fast", 4), s: F.round("_slow", 4)})
    states = numbered.withColumn("crossover_signal", crossover_signal(f, s))
    decided = F.when(F.col("crossover_signal") != NEUTRAL, F.col("crossover_signal"))
    block = F.floor((F.col("_rn") - 1) / rows) if segment else F.lit(0)
    states = states.withColumns({"_decided": decided, "_blk": block})
    inside = Window.partitionBy("symbol", "_blk").orderBy("_rn").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("_decided", ignorenulls=True).over(inside)
    if segment:
        ends = states.filter("_decided is not null").groupBy("symbol", "_blk").agg(F.max_by("_decided", "_rn").alias("_end"))
        # a block without a decided bar has no end: every block takes the last one before it
        every = states.groupBy("symbol", "_blk").agg(F.count(F.lit(1)).alias("_n")).join(ends, ["symbol", "_blk"], "left")
        along = Window.partitionBy("symbol").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
        carried = every.select("symbol", "_blk", F.last("_end", ignorenulls=True).over(along).alias("_carried"))
        states = states.join(carried, ["symbol", "_blk"])
        before = F.coalesce(before, F.col("_carried"))
    out = states.withColumn("previous_signal", before).filter("_decided <> previous_signal")
    out = out.select("symbol", "date", "close", f, s, "crossover_signal", "previous_signal")
    return out.orderBy("symbol", "date") if ordered else out


def latest_signal(vw_summary: DataFrame) -> DataFrame:
    """Per symbol: latest date and the MA-30 signal / label *of that date*.

    Deterministic replacement for an unordered LAST(): ``max_by(.., date)``,
    a partial/final aggregate (one row per symbol per input partition crosses
    the shuffle).
    """
    return (
        vw_summary.groupBy("symbol")
        .agg(
            F.max("date").alias("latest_date"),
            F.max_by("ma30_signal", "date").alias("ma30_signal"),
            F.max_by("performance_label", "date").alias("last_performance"),
        )
        .orderBy("symbol")
    )


def top_gains(vw_summary: DataFrame, symbol: str | None = None, k: int = REPORT_TOP_K) -> DataFrame:
    """Best ``k`` days by display return, per symbol (or for one symbol).

    Ties on the return are broken by the earlier date. For all symbols the
    per-symbol limit runs as ``row_number() <= k`` (WindowGroupLimit before the
    shuffle); for one symbol it is a plain top-k (TakeOrderedAndProject).
    """
    cols = ["symbol", "date", "close", "daily_return_pct", "performance_label"]
    order = [F.col("daily_return_pct").desc_nulls_last(), F.col("date").asc_nulls_last()]
    if symbol is not None:
        return _for_symbol(vw_summary, symbol).select(*cols).orderBy(*order).limit(k)
    w = Window.partitionBy("symbol").orderBy(*order)
    return (
        vw_summary.select(*cols)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= k)
        .drop("_rn")
    )


def top_volume_spikes(vw_spikes: DataFrame, k: int = REPORT_TOP_K) -> DataFrame:
    """The ``k`` largest volume ratios overall (ties: symbol, then date)."""
    return (
        vw_spikes.select("symbol", "date", "volume_ratio", "daily_return_pct")
        .orderBy(
            F.col("volume_ratio").desc_nulls_last(),
            F.col("symbol").asc_nulls_last(),
            F.col("date").asc_nulls_last(),
        )
        .limit(k)
    )
