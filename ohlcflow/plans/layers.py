"""The layered job: bronze -> silver -> quality gate -> gold -> SQL layer.

Each layer is written once and read back with its schema, so later stages
scan columnar files instead of recomputing the lineage, and a lost executor
only costs the tasks of the current stage. Row counts are collected with
``observe`` during the writes (no extra count jobs).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from ..functions.sql import register_sql_functions
from .skew import should_segment
from ..operators.marts import stock_summary, top_movers, volume_analysis
from ..operators.quality import RUNNER_CHECKS, assert_quality, dq_report
from ..operators.signals import latest_signal, top_gains, top_volume_spikes
from ..operators.views import register_views
from ..schemas import (
    EXPECTED_SYMBOLS,
    MA_WINDOWS,
    MAX_PRICE_SPIKE,
    MIN_ROWS_PER_SYMBOL,
    TOP_N,
)
from ..sources.tables import read_partitioned, read_table, write_table
from .silver import to_silver


@dataclass
class LayerResult:
    """Where each layer table was written, its row count (from ``observe``),
    the quality counts that passed the gate, and the schema it was written
    with (used to read it back without partition type inference)."""

    paths: dict[str, str]
    counts: dict[str, int] = field(default_factory=dict)
    quality: dict[str, int] = field(default_factory=dict)
    schemas: dict[str, StructType] = field(default_factory=dict)


def _write_observed(df: DataFrame, name: str, path: str, counts: dict, **kw) -> None:
    obs = Observation(name)
    write_table(df, path, observation=obs, **kw)
    counts[name] = int(obs.get["rows"])


#: Up to this many symbols get a folder each by default.
MAX_SYMBOL_FOLDERS = 1000


def folders_by_symbol(wanted: bool | None, bars: DataFrame) -> bool:
    """Resolve ``partition_by_symbol``: None makes folders for up to ``MAX_SYMBOL_FOLDERS`` symbols of ``bars``.

    A folder holds one small file or more, which every later scan lists and opens,
    so with very many symbols the files cost more than their rows. One job over the
    symbols; it counts up to the limit only.
    """
    if wanted is not None:
        return wanted
    return bars.select("symbol").distinct().limit(MAX_SYMBOL_FOLDERS + 1).count() <= MAX_SYMBOL_FOLDERS


def write_silver(
    silver: DataFrame,
    path: str,
    fmt: str = "parquet",
    counts: dict | None = None,
    partition_by_symbol: bool | None = None,
):
    """Rows range-partitioned on (symbol, date), so each task writes few files
    and a hot symbol spans tasks; Hive-partitioned by symbol unless
    ``partition_by_symbol`` is off (for many symbols: the files stay
    clustered by symbol, and Parquet min/max statistics still skip row groups
    on a symbol filter). None: by the number of symbols."""
    partition_by_symbol = folders_by_symbol(partition_by_symbol, silver)
    _write_observed(
        silver, "silver", path, counts if counts is not None else {},
        partition_by=["symbol"] if partition_by_symbol else None, fmt=fmt,
        cluster_by=["symbol", "date"], range_partition=True,
    )


def layer_paths(out_root: str) -> dict[str, str]:
    root = out_root.rstrip("/")
    return {
        "bronze": f"{root}/bronze/stock_prices",
        "silver": f"{root}/silver/stock_prices",
        "stock_summary": f"{root}/gold/stock_summary",
        "top_movers": f"{root}/gold/top_movers",
        "volume_analysis": f"{root}/gold/volume_analysis",
    }


def bronze_to_silver(
    spark: SparkSession,
    bronze: DataFrame,
    silver_path: str,
    max_spike: float = MAX_PRICE_SPIKE,
    fmt: str = "parquet",
    result: LayerResult | None = None,
    partition_by_symbol: bool | None = None,
) -> DataFrame:
    """Write silver (symbol-partitioned unless there are many) and return it read back."""
    res = result if result is not None else LayerResult({"silver": silver_path})
    silver = to_silver(bronze, max_spike)
    res.schemas["silver"] = silver.schema
    write_silver(silver, silver_path, fmt, res.counts, partition_by_symbol)
    return read_table(spark, silver_path, res.schemas["silver"], fmt)


def silver_to_gold(
    silver: DataFrame,
    paths: dict[str, str],
    windows: Sequence[int] = MA_WINDOWS,
    top_n: int = TOP_N,
    fmt: str = "parquet",
    result: LayerResult | None = None,
    segmented: bool | str = False,
    partition_by_symbol: bool | None = None,
) -> LayerResult:
    """Write the three gold tables from a silver DataFrame.

    ``segmented`` selects the per-symbol window plan (False: direct, True:
    block + halo, "auto": measure the longest series first).
    """
    res = result if result is not None else LayerResult(dict(paths))
    # "auto" is resolved once (one small job) for both per-symbol windows
    segmented = should_segment(segmented, silver)
    partition_by_symbol = folders_by_symbol(partition_by_symbol, silver)
    gold = {
        # stock_summary comes out of the window hash-partitioned by symbol and
        # sorted by (symbol, date): the partitioned write adds no shuffle.
        "stock_summary": (stock_summary(silver, windows, segmented=segmented),
                          dict(partition_by=["symbol"] if partition_by_symbol else None,
                               cluster_by=["symbol", "date"])),
        "top_movers": (top_movers(silver, top_n), dict(cluster_by=["date", "direction", "rank"])),
        "volume_analysis": (volume_analysis(silver, segmented=segmented),
                            dict(cluster_by=["date", "symbol"])),
    }
    for name, (df, kw) in gold.items():
        res.schemas[name] = df.schema
        _write_observed(df, name, paths[name], res.counts, fmt=fmt, **kw)
    return res


def run_layers(
    spark: SparkSession,
    bronze: DataFrame,
    out_root: str,
    expected_symbols: Sequence[str] = EXPECTED_SYMBOLS,
    gate_checks: Sequence[str] | None = None,
    windows: Sequence[int] = MA_WINDOWS,
    top_n: int = TOP_N,
    max_spike: float = MAX_PRICE_SPIKE,
    min_rows: int = MIN_ROWS_PER_SYMBOL,
    fmt: str = "parquet",
    segmented: bool | str = False,
    partition_by_symbol: bool | None = None,
) -> LayerResult:
    """Silver -> quality gate -> gold; raises ``QualityGateError`` (gold not
    written) when a gate check fails.

    ``partition_by_symbol`` lays silver and the summary out in a folder per symbol;
    by default (None) as long as there are no more than ``MAX_SYMBOL_FOLDERS``.
    """
    paths = layer_paths(out_root)
    res = LayerResult({k: v for k, v in paths.items() if k != "bronze"})
    partition_by_symbol = folders_by_symbol(partition_by_symbol, bronze)
    silver = bronze_to_silver(spark, bronze, paths["silver"], max_spike, fmt, res, partition_by_symbol)
    res.quality = assert_quality(dq_report(silver, expected_symbols, min_rows), gate_checks)
    return silver_to_gold(silver, paths, windows, top_n, fmt, res, segmented, partition_by_symbol)


def register_sql_layer(
    spark: SparkSession, result: LayerResult, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Temp views over the written tables plus the three analytical views,
    and the label / signal rules as session SQL functions.

    Tables are read with the schemas recorded when they were written, or,
    for a result rebuilt from paths alone, with ``symbol`` declared a string.
    """
    layer = {"stock_prices_silver": "silver", "stock_summary": "stock_summary",
             "top_movers": "top_movers", "volume_analysis": "volume_analysis"}
    tables = {}
    for name, key in layer.items():
        path = result.paths[key]
        schema = result.schemas.get(key)
        df = read_table(spark, path, schema, fmt) if schema else read_partitioned(spark, path, fmt)
        df.createOrReplaceTempView(name)
        tables[name] = df
    views = register_views(tables["stock_summary"], tables["top_movers"], tables["volume_analysis"])
    register_sql_functions(spark)
    return {**tables, **views}


def run_chain(
    spark: SparkSession,
    out_root: str,
    csv_path: str | None = None,
    symbol_files: dict[str, str] | None = None,
    expected_symbols: Sequence[str] = EXPECTED_SYMBOLS,
    gate_checks: Sequence[str] | None = None,
    max_files_per_trigger: int | None = None,
    fmt: str = "parquet",
) -> tuple[LayerResult, dict[str, DataFrame]]:
    """The whole chain in the reference's task order.

    produce (price CSVs -> JSON messages, written as files) -> consume
    (Structured Streaming -> bronze) -> silver -> quality gate -> gold -> SQL
    layer. Every step is a Spark job on the executors; the driver only
    coordinates. Returns the layer result and the registered tables/views.
    """
    root = out_root.rstrip("/")
    messages = f"{root}/messages"
    produce_messages(spark, messages, csv_path, symbol_files)
    bronze = consume_messages(spark, messages, root, max_files_per_trigger, fmt=fmt)
    result = run_layers(spark, bronze, root, expected_symbols, gate_checks, fmt=fmt)
    return result, register_sql_layer(spark, result, fmt)


def produce_messages(
    spark: SparkSession,
    messages_dir: str,
    csv_path: str | None = None,
    symbol_files: dict[str, str] | None = None,
) -> None:
    """Price CSVs -> JSON bar messages, written as text files (one per task)."""
    from ..sources.csv import scan_csv
    from ..sources.messages import encode_messages

    bars = scan_csv(spark, csv_path, symbol_files)
    encode_messages(bars).write.mode("overwrite").text(messages_dir)


def consume_messages(
    spark: SparkSession,
    messages_dir: str,
    out_root: str,
    max_files_per_trigger: int | None = None,
    source_label: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Drain the message files into ``<root>/bronze`` (checkpointed); returns bronze."""
    from ..schemas import BRONZE_SOURCE
    from ..streaming.ingest import message_stream, run_ingest

    root = out_root.rstrip("/")
    return run_ingest(
        spark,
        message_stream(spark, "files", messages_dir, max_per_trigger=max_files_per_trigger),
        layer_paths(root)["bronze"],
        f"{root}/_checkpoints/bronze",
        rejects_path=f"{root}/bronze/rejects",
        source_label=source_label or BRONZE_SOURCE,
        fmt=fmt,
    )


def run_sql_layer(
    spark: SparkSession,
    result: LayerResult,
    symbol: str | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Register the layer, gate on the runner's six checks (PASS/FAIL words),
    and return the report plus the three sample reports: best days
    (of ``symbol`` or per symbol), latest signal per symbol, top volume spikes.
    """
    views = register_sql_layer(spark, result, fmt)
    report = dq_report(views["stock_prices_silver"], passed="PASS", failed="FAIL")
    assert_quality(report, RUNNER_CHECKS)
    return {
        "dq_report": report,
        "top_gains": top_gains(views["vw_stock_summary"], symbol),
        "latest_signal": latest_signal(views["vw_stock_summary"]),
        "top_volume_spikes": top_volume_spikes(views["vw_volume_spikes"]),
    }
