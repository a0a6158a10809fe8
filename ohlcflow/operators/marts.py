"""Silver -> the three gold marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import direction
from ..plans.ranks import value_ranks
from ..schemas import MA_WINDOWS, TOP_N, VOLUME_WINDOW, ma_column
from .features import add_moving_averages, add_volume_spike_flag

SUMMARY_BASE = [
    "symbol", "date", "open", "high", "low", "close", "volume",
    "daily_return_pct", "price_range", "price_spike_flag",
]
MOVERS_COLUMNS = [
    "date", "symbol", "direction", "daily_return_pct", "abs_return", "close", "volume", "rank",
]
VOLUME_COLUMNS = [
    "symbol", "date", "volume", "avg_30d_volume", "close", "daily_return_pct", "volume_spike",
]


def stock_summary(
    silver: DataFrame,
    windows: Sequence[int] = MA_WINDOWS,
    keep_audit: bool = True,
    segmented: bool | str = False,
) -> DataFrame:
    """Daily bars with ``ma_{n}d`` for every window (one shuffle on symbol).

    ``_processed_at`` is carried when present and ``keep_audit`` is set.
    ``segmented``: see :func:`ohlcflow.operators.features.add_moving_averages`.
    """
    cols = SUMMARY_BASE + [ma_column(w) for w in windows]
    if keep_audit and "_processed_at" in silver.columns:
        cols.append("_processed_at")
    return add_moving_averages(silver, windows, segmented=segmented).select(*cols)


RANK_TABLE_LIMIT_BYTES = 64 << 20


def top_movers(silver: DataFrame, top_n: int = TOP_N, ties: str = "window") -> DataFrame:
    """Top ``top_n`` gainers and losers per date by absolute return.

    Spike rows are excluded before ranking; ranking is ``dense_rank`` over
    (date, direction) by ``abs_return`` descending (NULLs last), so ties share
    a rank and a group can return more than ``top_n`` rows. A zero or NULL
    return is a LOSER.

    ``ties="window"`` (default): ``rank <= top_n`` lets Spark insert a
    partial ``WindowGroupLimit`` below the shuffle, so a date holding a large
    share of all rows ships only its local top ranks per input partition.
    ``ties="join"``: ranks are computed on the distinct (date, direction,
    abs_return) values, whose ties collapse map-side, and joined back to the
    rows; no task ever holds a date's tied rows together, at the price of
    shuffling the distinct values. See :func:`_movers_by_value_ranks`.
    ``ties="range"``: the distinct values themselves are ranked over range
    partitions (:mod:`ohlcflow.plans.ranks`), so that no task holds a date's
    values either, for any ``top_n``.
    """
    cand = (
        silver.filter(~F.col("price_spike_flag"))
        .withColumn("direction", direction("daily_return_pct"))
        .withColumn("abs_return", F.abs("daily_return_pct"))
    )
    if ties == "join":
        return _movers_by_value_ranks(cand, top_n).select(*MOVERS_COLUMNS)
    if ties == "range":
        ranks = value_ranks(cand, ["date", "direction"], "abs_return").filter(F.col("rank") <= top_n)
        return _with_ranks(cand, ranks, top_n).select(*MOVERS_COLUMNS)
    if ties != "window":
        raise ValueError(f"ties must be 'window', 'join' or 'range', got {ties!r}")
    w = Window.partitionBy("date", "direction").orderBy(F.col("abs_return").desc_nulls_last())
    return (
        cand.withColumn("rank", F.dense_rank().over(w))
        .filter(F.col("rank") <= top_n)
        .select(*MOVERS_COLUMNS)
    )


def _movers_by_value_ranks(cand: DataFrame, top_n: int) -> DataFrame:
    """Dense ranks of the distinct values by a window per (date, direction)."""
    values = cand.select("date", "direction", "abs_return").distinct()
    w = Window.partitionBy("date", "direction").orderBy(F.col("abs_return").desc_nulls_last())
    ranks = values.withColumn("rank", F.dense_rank().over(w)).filter(F.col("rank") <= top_n)
    return _with_ranks(cand, ranks, top_n)


def _with_ranks(cand: DataFrame, ranks: DataFrame, top_n: int) -> DataFrame:
    """Ranks of the distinct values joined back to every row.

    The rank table has at most ``top_n`` rows per (date, direction); its size
    bound ``top_n x 2 x (distinct dates + 1)`` comes from one count-distinct
    aggregate over the low-cardinality date column, and it is broadcast when
    that bound is below ``RANK_TABLE_LIMIT_BYTES`` (else a shuffle join, which
    AQE splits when one value is hot).
    """
    ranks = ranks.select(
        F.col("date").alias("_r_date"),
        F.col("direction").alias("_r_dir"),
        F.col("abs_return").alias("_r_abs"),
        "rank",
    )
    # distinct dates (+1 for a NULL date): one small aggregate, any date type
    n_dates = cand.agg(F.count_distinct("date")).first()[0] + 1
    if top_n * 2 * n_dates * 48 <= RANK_TABLE_LIMIT_BYTES:
        ranks = F.broadcast(ranks)
    cond = (
        cand["date"].eqNullSafe(ranks["_r_date"])
        & (cand["direction"] == ranks["_r_dir"])
        & cand["abs_return"].eqNullSafe(ranks["_r_abs"])
    )
    return cand.join(ranks, cond, "inner").drop("_r_date", "_r_dir", "_r_abs")


def volume_analysis(
    silver: DataFrame, window: int = VOLUME_WINDOW, segmented: bool | str = False
) -> DataFrame:
    """Bars whose volume exceeds twice the trailing ``window``-row average."""
    avg_col = f"avg_{window}d_volume"
    cols = [avg_col if c == "avg_30d_volume" else c for c in VOLUME_COLUMNS]
    flagged = add_volume_spike_flag(silver, window, segmented=segmented)
    return flagged.filter(F.col("volume_spike")).select(*cols)
