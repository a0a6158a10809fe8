"""Analytical views over the gold marts.

Each view is a function DataFrame -> DataFrame; :func:`register_views` also
publishes them as session temp views under the reference names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import ma30_signal, performance_label
from ..schemas import VIEW_TOP_N


def vw_stock_summary(
    summary: DataFrame, with_price_range: bool = True, with_audit: bool = False
) -> DataFrame:
    """Display rounding (2 decimals) plus the MA-30 signal and performance label.

    Signal and label are computed from the stored 4-decimal values, not from
    the 2-decimal display values of the same name. ``with_price_range`` /
    ``with_audit`` select the fuller column set (rounded ``price_range``,
    ``_processed_at`` when present).
    """
    cols = [
        "symbol", "date", "open", "high", "low", "close", "volume",
        F.round("daily_return_pct", 2).alias("daily_return_pct"),
    ]
    if with_price_range:
        cols.append(F.round("price_range", 2).alias("price_range"))
    cols += [
        F.round("ma_7d", 2).alias("ma_7d"),
        F.round("ma_30d", 2).alias("ma_30d"),
        F.round("ma_90d", 2).alias("ma_90d"),
        ma30_signal("close", "ma_30d").alias("ma30_signal"),
        performance_label("daily_return_pct").alias("performance_label"),
        "price_spike_flag",
    ]
    if with_audit and "_processed_at" in summary.columns:
        cols.append("_processed_at")
    return summary.select(*cols)


def vw_top_movers(movers: DataFrame, top_n: int = VIEW_TOP_N, ordered: bool = True) -> DataFrame:
    """Movers with stored rank <= ``top_n``, display-rounded."""
    out = movers.filter(F.col("rank") <= top_n).select(
        "date", "symbol", "direction",
        F.round("daily_return_pct", 2).alias("daily_return_pct"),
        F.round("close", 2).alias("close"),
        "volume", "rank",
    )
    if ordered:
        out = out.orderBy(F.col("date").desc(), "direction", "rank")
    return out


def vw_volume_spikes(volume: DataFrame, ordered: bool = True) -> DataFrame:
    """Volume spikes with the volume / average ratio (from the unrounded average)."""
    out = volume.select(
        "symbol", "date", "volume",
        F.round("avg_30d_volume", 0).alias("avg_30d_volume"),
        F.round(F.try_divide(F.col("volume"), F.col("avg_30d_volume")), 2).alias("volume_ratio"),
        F.round("daily_return_pct", 2).alias("daily_return_pct"),
        "close",
    )
    if ordered:
        out = out.orderBy(F.col("volume_ratio").desc())
    return out


def register_views(summary: DataFrame, movers: DataFrame, volume: DataFrame) -> dict[str, DataFrame]:
    """Create (or replace) the three session temp views; return them by name."""
    views = {
        "vw_stock_summary": vw_stock_summary(summary, with_audit=True),
        "vw_top_movers": vw_top_movers(movers),
        "vw_volume_spikes": vw_volume_spikes(volume),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
