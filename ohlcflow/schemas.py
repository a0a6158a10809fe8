"""Schemas and default parameters of the daily-bar data model.

Every layer has an explicit ``StructType``; nothing is ever inferred. Files
written by the pipeline are read back with these schemas so that Parquet
partition discovery cannot re-type a column (an all-digit symbol would come
back as an integer, an empty string as NULL).
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values (must equal the reference for identical results) ---------
# Bar payload fields, in message order.
BAR_FIELDS = ["symbol", "date", "open", "high", "low", "close", "volume"]
PRICE_FIELDS = ["open", "high", "low", "close"]
# Moving-average windows in rows, top-N of the movers mart, price-spike
# threshold (fraction), minimum rows per symbol for the quality gate.
MA_WINDOWS = [7, 30, 90]
TOP_N = 10
MAX_PRICE_SPIKE = 0.50
MIN_ROWS_PER_SYMBOL = 100
# Volume spike: volume > 2 x average over the last 30 rows (current included).
VOLUME_WINDOW = 30
VOLUME_SPIKE_MULTIPLIER = 2
# View parameters: top movers shown per (date, direction), top-k reports.
VIEW_TOP_N = 5
REPORT_TOP_K = 5
# Expected symbols of the reference configuration.
EXPECTED_SYMBOLS = ["AAPL", "TSLA", "gogl", "MSFT", "AMZN"]
# Date format of raw bars; source label of bronze rows.
DATE_FORMAT = "yyyy-MM-dd"
BRONZE_SOURCE = "kafka"
SILVER_LAYER = "silver"
# Default value when a CSV header lacks a column: date -> "", numbers -> "0".
CSV_MISSING_DEFAULTS = {
    "date": "",
    "open": "0",
    "high": "0",
    "low": "0",
    "close": "0",
    "volume": "0",
}
# DQ status words.
DQ_PASSED = "PASSED"
DQ_FAILED = "FAILED"
# Mover direction: positive return, otherwise.
GAINER, LOSER = "GAINER", "LOSER"
# Close versus the 30-row average: above, below, equal or unknown.
MA30_ABOVE, MA30_BELOW, MA30_AT = "ABOVE", "BELOW", "AT"
# Performance labels, tested in this order: return >= 3, >= 1, <= -3, <= -1, else.
PERFORMANCE_LABELS = [
    (">=", 3, "STRONG GAIN"),
    (">=", 1, "GAIN"),
    ("<=", -3, "STRONG LOSS"),
    ("<=", -1, "LOSS"),
]
PERFORMANCE_DEFAULT = "FLAT"
# Fast versus slow average: above, below, otherwise.
GOLDEN_CROSS, DEATH_CROSS, NEUTRAL = "GOLDEN CROSS", "DEATH CROSS", "NEUTRAL"
# ---------------------------------------------------------------------------

RAW_BAR_SCHEMA = StructType([StructField(f, StringType(), True) for f in BAR_FIELDS])

TYPED_BAR_SCHEMA = StructType(
    [
        StructField("symbol", StringType(), True),
        StructField("date", DateType(), True),
        StructField("open", DoubleType(), True),
        StructField("high", DoubleType(), True),
        StructField("low", DoubleType(), True),
        StructField("close", DoubleType(), True),
        StructField("volume", LongType(), True),
    ]
)

BRONZE_AUDIT_FIELDS = [
    StructField("_ingested_at", TimestampType(), True),
    StructField("_batch_number", IntegerType(), True),
    StructField("_source", StringType(), True),
]

# Bronze tables written by the stream are partitioned by (_stream, _batch_number):
# _stream identifies the checkpoint, so a new stream never overwrites another's batches.
BRONZE_SCHEMA = StructType(
    RAW_BAR_SCHEMA.fields + BRONZE_AUDIT_FIELDS + [StructField("_stream", StringType(), True)]
)

SILVER_DERIVED_FIELDS = [
    StructField("daily_return_pct", DoubleType(), True),
    StructField("price_range", DoubleType(), True),
    StructField("price_spike_flag", BooleanType(), True),
]

# Silver of stream-ingested bronze: typed bars, the bronze audit columns
# (kept), derived columns, silver audit columns.
SILVER_SCHEMA = StructType(
    TYPED_BAR_SCHEMA.fields
    + BRONZE_AUDIT_FIELDS
    + [StructField("_stream", StringType(), True)]
    + SILVER_DERIVED_FIELDS
    + [
        StructField("_processed_at", TimestampType(), True),
        StructField("_layer", StringType(), True),
    ]
)


def ma_column(window: int) -> str:
    """Name of the moving-average column for an ``window``-row frame."""
    return f"ma_{window}d"


def stock_summary_schema(windows=MA_WINDOWS) -> StructType:
    return StructType(
        TYPED_BAR_SCHEMA.fields
        + SILVER_DERIVED_FIELDS
        + [StructField(ma_column(w), DoubleType(), True) for w in windows]
        + [StructField("_processed_at", TimestampType(), True)]
    )


TOP_MOVERS_SCHEMA = StructType(
    [
        StructField("date", DateType(), True),
        StructField("symbol", StringType(), True),
        StructField("direction", StringType(), False),
        StructField("daily_return_pct", DoubleType(), True),
        StructField("abs_return", DoubleType(), True),
        StructField("close", DoubleType(), True),
        StructField("volume", LongType(), True),
        StructField("rank", IntegerType(), False),
    ]
)

VOLUME_ANALYSIS_SCHEMA = StructType(
    [
        StructField("symbol", StringType(), True),
        StructField("date", DateType(), True),
        StructField("volume", LongType(), True),
        StructField("avg_30d_volume", DoubleType(), True),
        StructField("close", DoubleType(), True),
        StructField("daily_return_pct", DoubleType(), True),
        StructField("volume_spike", BooleanType(), False),
    ]
)

DQ_REPORT_SCHEMA = StructType(
    [
        StructField("check_name", StringType(), False),
        StructField("fail_count", LongType(), False),
        StructField("status", StringType(), False),
    ]
)
