"""Bronze -> typed, valid, deduplicated bars.

``cast_schema`` types the raw string payload, ``filter_valid_prices`` drops
rows that cannot be a price bar and ``deduplicate`` keeps one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import is_finite, parse_date, parse_double, parse_long
from ..schemas import DATE_FORMAT, PRICE_FIELDS

KEY_COLUMNS = ("symbol", "date")
PAYLOAD_ORDER = ("open", "high", "low", "close", "volume")


def cast_schema(df: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    """Type the bar columns in place; unparseable values become NULL.

    date: strict ``date_format`` parse; open/high/low/close: double;
    volume: long with the legacy cast rules (fraction truncated). No row is
    ever dropped here; other columns (audit columns) pass through.
    """
    return df.withColumns(
        {
            "date": parse_date("date", date_format),
            **{c: parse_double(c) for c in PRICE_FIELDS},
            "volume": parse_long("volume"),
        }
    )


def _valid_prices(finite_only: bool) -> Column:
    """The bare conjunction: a filter on it reaches the scan; NULL counts as not true there."""
    cond = (
        (F.col("open") > 0)
        & (F.col("high") > 0)
        & (F.col("low") > 0)
        & (F.col("close") > 0)
        & (F.col("volume") >= 0)
        & (F.col("high") >= F.col("low"))
    )
    if finite_only:
        for c in PRICE_FIELDS:
            cond = cond & is_finite(c)
    return cond


def valid_price_predicate(finite_only: bool = True) -> Column:
    """Prices > 0, volume >= 0, high >= low; NULL in any of them fails.

    NULL ``symbol`` and NULL ``date`` are *not* rejected: they reach silver on
    purpose so that the quality gate can report them. With ``finite_only``
    (default) NaN and infinite prices are rejected as well; plain comparison
    would keep NaN, since NaN sorts above every number.
    """
    # two-valued, for callers that select it
    return F.coalesce(_valid_prices(finite_only), F.lit(False))


def filter_valid_prices(df: DataFrame, finite_only: bool = True) -> DataFrame:
    return df.filter(_valid_prices(finite_only))


def default_dedup_order(df: DataFrame) -> list[Column]:
    """Earliest ingest first (time, then batch number), then the lowest payload.

    Makes the surviving row independent of input order and partitioning.
    """
    order = []
    for audit in ("_ingested_at", "_batch_number"):
        if audit in df.columns:
            order.append(F.col(audit).asc())
    order += [F.col(c).asc() for c in PAYLOAD_ORDER if c in df.columns]
    return order


def deduplicate(
    df: DataFrame,
    key_cols: Sequence[str] = KEY_COLUMNS,
    order_by: Sequence[Column] | None = None,
    deterministic: bool = True,
) -> DataFrame:
    """Keep one row per key; NULL keys compare equal.

    Deterministic form: ``row_number() = 1`` over the key ordered by
    ``order_by`` (default :func:`default_dedup_order`). Spark plans this as a
    partial ``WindowGroupLimit`` before the shuffle and a final one after,
    so a key with millions of copies sends at most one row per input
    partition through the exchange. ``deterministic=False`` keeps any row
    (``dropDuplicates``, partial/final hash aggregate).
    """
    key_cols = list(key_cols)
    if not deterministic:
        return df.dropDuplicates(key_cols)
    order = list(order_by) if order_by is not None else default_dedup_order(df)
    if not order:
        return df.dropDuplicates(key_cols)
    w = Window.partitionBy(*key_cols).orderBy(*order)
    return (
        df.withColumn("_dedup_rn", F.row_number().over(w))
        .filter(F.col("_dedup_rn") == 1)
        .drop("_dedup_rn")
    )
