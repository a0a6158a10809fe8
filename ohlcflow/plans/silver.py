"""Bronze -> silver as one pure DataFrame function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import cast_schema, deduplicate, filter_valid_prices
from ..operators.features import add_daily_return, add_price_range, add_price_spike_flag
from ..schemas import MAX_PRICE_SPIKE, SILVER_LAYER


def to_silver(
    bronze: DataFrame,
    max_spike: float = MAX_PRICE_SPIKE,
    audit: bool = True,
    finite_only: bool = True,
) -> DataFrame:
    """Cast -> validity filter -> dedup on (symbol, date) -> derived columns.

    The filter runs before dedup, so an invalid copy never hides a valid one.
    Bronze audit columns pass through; ``audit`` adds ``_processed_at`` and
    ``_layer``.
    """
    df = cast_schema(bronze)
    df = filter_valid_prices(df, finite_only=finite_only)
    df = deduplicate(df, ["symbol", "date"])
    df = add_price_spike_flag(add_price_range(add_daily_return(df)), max_spike)
    if audit:
        df = df.withColumns(
            {"_processed_at": F.current_timestamp(), "_layer": F.lit(SILVER_LAYER)}
        )
    return df
