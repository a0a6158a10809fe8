"""Registered queries (Spark) and their independent DuckDB SQL oracles.

Inputs are derived from the shared ``lineitem`` table:

* clean bars: daily OHLCV per (symbol, ship date), see ``sources.fixtures``;
* dirty bars: the clean bars as raw strings with injected defects.

Oracle rules for exact agreement: Spark rounds doubles HALF_UP on their
decimal text, so the SQL side rounds ``cast(cast(x as varchar) as
decimal)``; ascending window order is written ``NULLS FIRST`` (Spark's
default); ranks are cast to ``integer`` and counts to ``bigint``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from .operators import clean as C
from .operators import features as FE
from .operators import marts as M
from .operators import quality as DQ
from .operators import signals as S
from .operators import views as V
from .plans.incremental import IncrementalLayers
from .plans.layers import run_layers
from .plans.quality_state import QualityState
from .plans.silver import to_silver
from .plans.storage import scratch_path
from .schemas import BAR_FIELDS, BRONZE_SCHEMA, RAW_BAR_SCHEMA
from .sources.csv import scan_csv
from .sources.fixtures import bars_from_ticks, dirty_bars
from .sources.messages import decode_messages, encode_messages, message_table
from .sources.tables import read_table, write_clustered
from .streaming.ingest import message_stream, run_ingest
from .streaming.silver import run_silver_stream

# Expected symbols used by the quality keys: one present, one absent.
DQ_EXPECTED = ["S00", "ZZZ"]
BAR_KEY = ["symbol", "date"]


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clean_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars aggregated from all of ``lineitem`` (typed)."""
    return bars_from_ticks(_table(spark, sf_dir, "lineitem"))


def raw_dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean bars as raw strings with injected defects (bronze-like)."""
    return dirty_bars(clean_bars(spark, sf_dir))


def clean_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean bars with the silver derived columns (no audit columns)."""
    bars = clean_bars(spark, sf_dir)
    return FE.add_price_spike_flag(FE.add_price_range(FE.add_daily_return(bars)))


def dirty_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(raw_dirty_bars(spark, sf_dir), audit=False)


def _summary(spark, sf_dir):
    return M.stock_summary(clean_silver(spark, sf_dir))


def _movers(spark, sf_dir):
    return M.top_movers(clean_silver(spark, sf_dir))


def _volume(spark, sf_dir):
    return M.volume_analysis(clean_silver(spark, sf_dir))


def q_cast_schema(spark, sf_dir):
    return C.cast_schema(raw_dirty_bars(spark, sf_dir))


def q_filter_valid(spark, sf_dir):
    return C.filter_valid_prices(q_cast_schema(spark, sf_dir))


def q_dedup(spark, sf_dir):
    return C.deduplicate(q_cast_schema(spark, sf_dir), BAR_KEY)


def q_silver(spark, sf_dir):
    return dirty_silver(spark, sf_dir)


def q_daily_return(spark, sf_dir):
    return FE.add_daily_return(clean_bars(spark, sf_dir)).select(*BAR_KEY, "daily_return_pct")


def q_price_range(spark, sf_dir):
    return FE.add_price_range(clean_bars(spark, sf_dir)).select(*BAR_KEY, "price_range")


def q_price_spike(spark, sf_dir):
    return clean_silver(spark, sf_dir).select(*BAR_KEY, "daily_return_pct", "price_spike_flag")


def q_moving_average(spark, sf_dir):
    return FE.add_moving_averages(clean_bars(spark, sf_dir), [7, 30, 90]).select(
        *BAR_KEY, "close", "ma_7d", "ma_30d", "ma_90d"
    )


def q_volume_spike(spark, sf_dir):
    return FE.add_volume_spike_flag(clean_bars(spark, sf_dir)).select(
        *BAR_KEY, "volume", "avg_30d_volume", "volume_spike"
    )


# Block size for the segmented keys: small enough that every series of the
# test tables is split into several blocks with halos.
SEGMENT_ROWS = 100


def q_moving_average_segmented(spark, sf_dir):
    # the numbered rows are stored, so columns not asked for are left out before
    bars = clean_bars(spark, sf_dir).select(*BAR_KEY, "close")
    return FE.add_moving_averages(bars, [7, 30, 90], segmented=True, block_rows=SEGMENT_ROWS).select(*BAR_KEY, "close", "ma_7d", "ma_30d", "ma_90d")


def q_volume_spike_segmented(spark, sf_dir):
    bars = clean_bars(spark, sf_dir).select(*BAR_KEY, "volume")
    return FE.add_volume_spike_flag(bars, segmented=True, block_rows=SEGMENT_ROWS).select(*BAR_KEY, "volume", "avg_30d_volume", "volume_spike")


def q_moving_average_prefix(spark, sf_dir):
    """All price averages from running sums (blocks shorter than the series)."""
    return FE.add_moving_averages(
        clean_bars(spark, sf_dir), [7, 30, 90], frames="prefix", block_rows=SEGMENT_ROWS
    ).select(*BAR_KEY, "close", "ma_7d", "ma_30d", "ma_90d")


def q_volume_spike_prefix(spark, sf_dir):
    """The volume average from running sums, rows numbered over range partitions."""
    return FE.add_volume_spike_flag(
        clean_bars(spark, sf_dir), frames="prefix", segmented=True, block_rows=SEGMENT_ROWS
    ).select(*BAR_KEY, "volume", "avg_30d_volume", "volume_spike")


def q_stock_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def q_top_movers(spark, sf_dir):
    return _movers(spark, sf_dir)


def q_top_movers_value_ranks(spark, sf_dir):
    """The movers mart by the tie-safe plan (ranks of distinct values joined back)."""
    return M.top_movers(clean_silver(spark, sf_dir), ties="join")


def q_top_movers_top3(spark, sf_dir):
    """The three largest movers of each date, a rank limit that cuts rows at every scale."""
    return M.top_movers(clean_silver(spark, sf_dir), top_n=3)


def q_top_movers_range_ranks(spark, sf_dir):
    """The same three movers, ranked over range partitions of the distinct values."""
    return M.top_movers(clean_silver(spark, sf_dir), top_n=3, ties="range")


def q_volume_analysis(spark, sf_dir):
    return _volume(spark, sf_dir)


def q_vw_stock_summary(spark, sf_dir):
    return V.vw_stock_summary(_summary(spark, sf_dir))


def q_vw_top_movers(spark, sf_dir):
    return V.vw_top_movers(_movers(spark, sf_dir))


def q_vw_volume_spikes(spark, sf_dir):
    return V.vw_volume_spikes(_volume(spark, sf_dir))


def q_sma_7d(spark, sf_dir):
    return S.sma(clean_bars(spark, sf_dir), 7)


def q_sma_30d(spark, sf_dir):
    return S.sma(clean_bars(spark, sf_dir), 30)


def q_crossover(spark, sf_dir):
    return S.crossover(clean_bars(spark, sf_dir))


def q_crossover_edges(spark, sf_dir):
    """Crossings of the two averages, states carried across blocks of a split series."""
    return S.crossover_edges(clean_bars(spark, sf_dir), segmented=True, block_rows=SEGMENT_ROWS)


def q_crossover_join(spark, sf_dir):
    return S.crossover_join(clean_bars(spark, sf_dir))


def q_top_gains(spark, sf_dir):
    return S.top_gains(q_vw_stock_summary(spark, sf_dir))


def q_top_volume_spikes(spark, sf_dir):
    return S.top_volume_spikes(q_vw_volume_spikes(spark, sf_dir))


def q_latest_signal(spark, sf_dir):
    return S.latest_signal(q_vw_stock_summary(spark, sf_dir))


def q_dq_report(spark, sf_dir):
    return DQ.dq_report(dirty_silver(spark, sf_dir), DQ_EXPECTED)


def q_dq_report_runner(spark, sf_dir):
    """The SQL-layer runner's six checks with PASS/FAIL status words."""
    rep = DQ.dq_report(dirty_silver(spark, sf_dir), passed="PASS", failed="FAIL")
    return rep.filter(F.col("check_name").isin(DQ.RUNNER_CHECKS))


def q_dq_gate_checks(spark, sf_dir):
    """The orchestration gate's three checks (its price test: open/close only)."""
    rep = DQ.dq_report(dirty_silver(spark, sf_dir), price_columns=("open", "close"))
    return rep.filter(F.col("check_name").isin(DQ.GATE_CHECKS))


def q_dq_duplicates(spark, sf_dir):
    return DQ.dq_duplicates(q_filter_valid(spark, sf_dir))


# A row limit that some symbols of every test scale miss (theirs have about 500 rows each).
SPLITTING_ROWS = 530


def q_dq_low_rows(spark, sf_dir):
    return DQ.dq_low_rows(dirty_silver(spark, sf_dir), min_rows=SPLITTING_ROWS)


def q_missing_symbols(spark, sf_dir):
    return DQ.missing_symbols(dirty_silver(spark, sf_dir), DQ_EXPECTED)


def q_missing_symbols_not_in(spark, sf_dir):
    return DQ.missing_symbols(dirty_silver(spark, sf_dir), DQ_EXPECTED, null_aware=True)


def q_missing_symbols_not_in_named(spark, sf_dir):
    """The null-aware form on the rows that have a symbol, where it is not empty."""
    named = dirty_silver(spark, sf_dir).filter("symbol is not null")
    return DQ.missing_symbols(named, DQ_EXPECTED, null_aware=True)


def q_encode_messages(spark, sf_dir):
    return encode_messages(clean_bars(spark, sf_dir))


def q_decode_messages(spark, sf_dir):
    return C.cast_schema(decode_messages(encode_messages(clean_bars(spark, sf_dir))))


def _typed_bars(df: DataFrame) -> DataFrame:
    return C.cast_schema(df).select(*BAR_FIELDS)


# CSV header variants written by the scan_csv key: capitalised with an extra
# column, and lower case in another column order.
CSV_VARIANT_A = ["Date", "Open", "High", "Low", "Close", "Volume", "OpenInt"]
CSV_VARIANT_B = ["close", "date", "open", "high", "low", "volume"]


def write_price_csvs(bars: DataFrame, root: str) -> None:
    """Write bars as ``symbol=<s>/*.csv`` files with two header variants."""
    even = F.ascii(F.substring("symbol", -1, 1)) % 2 == 0  # both variants occur at every scale
    a = bars.filter(even).select(
        *[F.col(c.lower()).alias(c) for c in CSV_VARIANT_A[:-1]],
        F.lit(0).alias("OpenInt"), "symbol",
    )
    b = bars.filter(~even).select(*CSV_VARIANT_B, "symbol")
    for i, part in enumerate((a, b)):
        _by_symbol(part).mode("overwrite" if i == 0 else "append").option("header", True).csv(root)


def _by_symbol(bars: DataFrame):
    """A writer of one folder and one file per symbol.

    Each symbol's rows go to one task first: without it every task holds rows of
    every symbol and writes a file for each. The files are moved to their place by
    the tasks (commit algorithm 2, the folder is a fresh one), not one after the
    other by the driver.
    """
    return bars.repartition("symbol").write.option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy("symbol")


def q_scan_csv(spark, sf_dir):
    root = scratch_path(spark, "price-csv")
    write_price_csvs(clean_bars(spark, sf_dir), root)
    return _typed_bars(scan_csv(spark, root))


def write_symbol_files(spark, bars: DataFrame, root: str) -> dict[str, str]:
    """One CSV file per symbol (``symbol=<s>/part-*.csv``); returns symbol -> file."""
    _by_symbol(bars).option("header", True).csv(root)
    # the written file of each symbol, from the table's file listing
    files = spark.read.schema("value string").text(root, recursiveFileLookup=True).inputFiles()
    return {re.search(r"symbol=([^/]+)/", f).group(1): f for f in files}


def q_scan_csv_multiline(spark, sf_dir):
    """Files whose first column holds line breaks, commas and quotes in quoted cells."""
    root = scratch_path(spark, "quoted-csv")
    note = F.format_string('of %s,\n"closed"\n\nat %s', F.col("date").cast("string"), F.col("close").cast("string"))
    bars = clean_bars(spark, sf_dir).select(note.alias("Note"), "*")
    _by_symbol(bars).option("header", True).option("quoteAll", True).option("escape", '"').csv(root)
    return _typed_bars(scan_csv(spark, root))


# Messages that the bounded consume takes.
CONSUME_MESSAGES = 3333


def q_consume_bounded(spark, sf_dir):
    """The first messages of a feed that was written in the order of date and symbol."""
    src = scratch_path(spark, "bounded-messages")
    bars = clean_bars(spark, sf_dir).repartitionByRange(16, "date", "symbol").sortWithinPartitions("date", "symbol")
    encode_messages(bars).write.text(src)
    return _typed_bars(decode_messages(message_table(spark, src), max_messages=CONSUME_MESSAGES))


def q_clustered_stock_summary(spark, sf_dir):
    """The summary from a silver table bucketed by symbol."""
    path = scratch_path(spark, "clustered")
    table = write_clustered(clean_silver(spark, sf_dir), f"silver_{path.rsplit('-', 1)[1]}", path, buckets=16)
    return M.stock_summary(table)


def q_dq_report_batches(spark, sf_dir):
    """Checks of the valid rows before dedup, from counts kept per batch: one
    batch compacted, one replayed, and a row limit that splits the symbols."""
    rows = C.filter_valid_prices(C.cast_schema(batched_bronze(spark, sf_dir)))
    state = QualityState(spark, scratch_path(spark, "quality-state"))
    for batch in (1, 2, 2, 3):
        state.add(rows.filter(F.col("_batch_number") == batch))
        if batch == 1:
            state.compact()
    return state.report(DQ_EXPECTED, min_rows=SPLITTING_ROWS)


def q_scan_csv_symbol_map(spark, sf_dir):
    """Files named by a symbol -> file map (no symbol in the data or path
    parsing); a configured file that does not exist contributes no rows."""
    root = scratch_path(spark, "symbol-files")
    files = write_symbol_files(spark, clean_bars(spark, sf_dir), root)
    files["ZZZ"] = f"{root}/missing.csv"
    return _typed_bars(scan_csv(spark, symbol_files=files))


def q_ingest_stream(spark, sf_dir):
    src = scratch_path(spark, "messages")
    encode_messages(clean_bars(spark, sf_dir)).write.text(src)
    # malformed messages, which go to the rejects table
    spark.createDataFrame([("not json",), ('{"symbol":"S00"',)], "value string").write.mode("append").text(src)
    bronze = run_ingest(
        spark,
        message_stream(spark, "files", src, max_per_trigger=2),
        scratch_path(spark, "bronze"),
        scratch_path(spark, "bronze-ckpt"),
    )
    return _typed_bars(bronze)


# The streaming key's input arrives in this many slices of time; a bar is late
# when it is more than two slices older than the latest one.
STREAM_SLICES = 3


def q_streaming_silver(spark, sf_dir):
    """Silver kept up by the stateful stream: the messages of one slice of time
    after the other, each slice's messages of one day in seven sent again after
    it, and the stream stopped and started again from its checkpoint in between."""
    bars = scratch_path(spark, "stream-bars")
    # the day is parsed once; the bars are read again for each slice
    raw_dirty_bars(spark, sf_dir).withColumn("_day", F.try_to_date("date")).write.parquet(bars)
    raw = spark.read.schema(StructType([*RAW_BAR_SCHEMA.fields, StructField("_day", DateType())])).parquet(bars)
    first, last = raw.agg(F.min("_day"), F.max("_day")).first()
    days = (last - first).days // STREAM_SLICES + 1
    number = F.coalesce(F.floor(F.datediff("_day", F.lit(first)) / days), F.lit(0))
    src, silver, ckpt = (scratch_path(spark, n) for n in ("stream-messages", "stream-silver", "stream-ckpt"))
    again = F.col("symbol").isNotNull() & (F.dayofyear("_day") % 7 == 0)
    for k in range(STREAM_SLICES):
        part = raw.filter(number == k)
        for rows in (part, part.filter(again)):
            encode_messages(rows).write.mode("append").text(src)
            run = run_silver_stream(spark, message_stream(spark, "files", src), silver, ckpt, delay=f"{2 * days} days")
    return run.table.drop("_processed_at", "_layer", "_batch_number", "_stream")


def batched_bronze(spark, sf_dir) -> DataFrame:
    """Dirty bars as three bronze batches: by date, a tenth of every fourth
    symbol's bars one batch late, and some bars of the first sent again in the third."""
    once = clean_bars(spark, sf_dir)  # aggregated once for the three batches
    stored = scratch_path(spark, "increment-bars")
    once.write.parquet(stored)
    bars = spark.read.schema(once.schema).parquet(stored)
    own = F.when(F.col("date") < "1995-06-01", 1).when(F.col("date") < "1997-06-01", 2).otherwise(3)
    late = (F.ascii(F.substring("symbol", -1, 1)) % 4 == 0) & (F.col("volume") % 10 == 0)
    batch = F.least(own + F.when(late, 1).otherwise(0), F.lit(3))
    sent = F.when((batch == 1) & (F.col("volume") % 7 == 0), F.array(batch, F.lit(3))).otherwise(F.array(batch))
    sent_bars = bars.select("*", F.explode(sent).alias("_batch_number"))
    parts = [
        dirty_bars(sent_bars.filter(F.col("_batch_number") == b).drop("_batch_number")).withColumns(
            {
                "_ingested_at": F.lit(f"2024-01-0{b} 00:00:00").cast("timestamp"),
                "_batch_number": F.lit(b),
                "_source": F.lit("files"),
                "_stream": F.lit("bars"),
            }
        )
        for b in (1, 2, 3)
    ]
    path = scratch_path(spark, "increment-bronze")
    for p in parts:
        p.write.mode("append").partitionBy("_stream", "_batch_number").parquet(path)
    return read_table(spark, path, BRONZE_SCHEMA)


def incremental_layers(spark, sf_dir) -> IncrementalLayers:
    """Layers after the three batches were taken up one by one."""
    bronze = batched_bronze(spark, sf_dir)
    layers = IncrementalLayers(spark, scratch_path(spark, "incremental"), top_n=3)
    for b in (1, 2, 3):
        layers.apply(bronze.filter(F.col("_batch_number") <= b))
    return layers


def q_incremental_silver(spark, sf_dir):
    return incremental_layers(spark, sf_dir).table("silver").select(
        *BAR_FIELDS, "_batch_number", "daily_return_pct", "price_range", "price_spike_flag"
    )


def q_incremental_stock_summary(spark, sf_dir):
    return incremental_layers(spark, sf_dir).table("stock_summary").drop("_processed_at")


def q_incremental_marts(spark, sf_dir):
    """Movers and volume spikes of the incremental layers, as one table of bars."""
    layers = incremental_layers(spark, sf_dir)
    movers = layers.table("top_movers").select(F.lit("mover").alias("mart"), "symbol", "date", F.col("abs_return").alias("value"), F.col("rank").cast("long").alias("rank"))
    spikes = layers.table("volume_analysis").select(F.lit("volume").alias("mart"), "symbol", "date", F.col("avg_30d_volume").alias("value"), F.lit(None).cast("long").alias("rank"))
    return movers.unionByName(spikes)


def q_written_stock_summary(spark, sf_dir):
    """Layered job on the clean bars as raw strings; gold read back."""
    raw = clean_bars(spark, sf_dir).select(*[F.col(c).cast("string") for c in BAR_FIELDS])
    res = run_layers(
        spark, raw, scratch_path(spark, "layers"), expected_symbols=["S00"],
        gate_checks=DQ.GATE_CHECKS,
    )
    schema = res.schemas["stock_summary"]
    return read_table(spark, res.paths["stock_summary"], schema).drop("_processed_at")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "cast_schema": q_cast_schema,
    "filter_valid": q_filter_valid,
    "dedup": q_dedup,
    "silver": q_silver,
    "daily_return": q_daily_return,
    "price_range": q_price_range,
    "price_spike": q_price_spike,
    "moving_average": q_moving_average,
    "volume_spike": q_volume_spike,
    "moving_average_segmented": q_moving_average_segmented,
    "volume_spike_segmented": q_volume_spike_segmented,
    "moving_average_prefix": q_moving_average_prefix,
    "volume_spike_prefix": q_volume_spike_prefix,
    "stock_summary": q_stock_summary,
    "top_movers": q_top_movers,
    "top_movers_value_ranks": q_top_movers_value_ranks,
    "top_movers_top3": q_top_movers_top3,
    "top_movers_range_ranks": q_top_movers_range_ranks,
    "volume_analysis": q_volume_analysis,
    "vw_stock_summary": q_vw_stock_summary,
    "vw_top_movers": q_vw_top_movers,
    "vw_volume_spikes": q_vw_volume_spikes,
    "sma_7d": q_sma_7d,
    "sma_30d": q_sma_30d,
    "crossover": q_crossover,
    "crossover_join": q_crossover_join,
    "crossover_edges": q_crossover_edges,
    "top_gains": q_top_gains,
    "top_volume_spikes": q_top_volume_spikes,
    "latest_signal": q_latest_signal,
    "dq_report": q_dq_report,
    "dq_report_runner": q_dq_report_runner,
    "dq_gate_checks": q_dq_gate_checks,
    "dq_duplicates": q_dq_duplicates,
    "dq_low_rows": q_dq_low_rows,
    "missing_symbols": q_missing_symbols,
    "missing_symbols_not_in": q_missing_symbols_not_in,
    "missing_symbols_not_in_named": q_missing_symbols_not_in_named,
    "dq_report_batches": q_dq_report_batches,
    "encode_messages": q_encode_messages,
    "decode_messages": q_decode_messages,
    "scan_csv": q_scan_csv,
    "scan_csv_symbol_map": q_scan_csv_symbol_map,
    "scan_csv_multiline": q_scan_csv_multiline,
    "consume_bounded": q_consume_bounded,
    "clustered_stock_summary": q_clustered_stock_summary,
    "ingest_stream": q_ingest_stream,
    "written_stock_summary": q_written_stock_summary,
    "streaming_silver": q_streaming_silver,
    "incremental_silver": q_incremental_silver,
    "incremental_stock_summary": q_incremental_stock_summary,
    "incremental_marts": q_incremental_marts,
}


# --------------------------------------------------------------------------
# DuckDB oracle side
# --------------------------------------------------------------------------


def R(x: str, n: int) -> str:
    """Spark-compatible HALF_UP rounding of a double in DuckDB."""
    return f"cast(round(cast(cast(({x}) AS varchar) AS decimal(38,16)), {n}) AS double)"


def _w(n: int) -> str:
    return (
        "OVER (PARTITION BY symbol ORDER BY date ASC NULLS FIRST "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    )


_PRICE = "(100 + floor(l_extendedprice / 2000 * 64) / 64)"
_ORD = "row(l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity)"

CTE_CLEAN = f"""clean_bars AS (
  SELECT printf('S%02d', l_suppkey) AS symbol,
         cast(l_shipdate AS date) AS date,
         cast(arg_min({_PRICE}, {_ORD}) AS double) AS open,
         cast(max({_PRICE}) AS double) AS high,
         cast(min({_PRICE}) AS double) AS low,
         cast(arg_max({_PRICE}, {_ORD}) AS double) AS close,
         cast(sum(l_quantity) AS bigint) AS volume
  FROM lineitem GROUP BY 1, 2)"""

CTE_SILVER_C = f"""silver_c0 AS (
  SELECT *, {R("(close - open) / open * 100", 4)} AS daily_return_pct,
         {R("high - low", 4)} AS price_range
  FROM clean_bars),
silver_c AS (
  SELECT *, coalesce(abs(daily_return_pct) > 50.0, false) AS price_spike_flag FROM silver_c0)"""

CTE_DIRTY = """raw_bars AS (
  SELECT symbol, cast(date AS varchar) AS date, cast(open AS varchar) AS open,
         cast(high AS varchar) AS high, cast(low AS varchar) AS low,
         cast(close AS varchar) AS close, cast(volume AS varchar) AS volume,
         low AS _low, (dayofyear(date) * 7 + volume) % 97 AS _k
  FROM clean_bars),
dirty_bars AS (
  SELECT CASE WHEN _k = 3 THEN NULL ELSE symbol END AS symbol,
         CASE WHEN _k = 4 THEN 'not-a-date' ELSE date END AS date,
         CASE WHEN _k = 1 THEN '-' || open ELSE open END AS open,
         CASE WHEN _k = 2 THEN cast(_low - 1 AS varchar) ELSE high END AS high,
         low,
         CASE WHEN _k = 6 THEN 'n/a' ELSE close END AS close,
         CASE WHEN _k = 5 THEN '' ELSE volume END AS volume
  FROM raw_bars
  UNION ALL
  SELECT symbol, date, open, high, low, close, volume FROM raw_bars WHERE _k = 0),
typed AS (
  SELECT symbol, try_cast(date AS date) AS date, try_cast(open AS double) AS open,
         try_cast(high AS double) AS high, try_cast(low AS double) AS low,
         try_cast(close AS double) AS close, try_cast(volume AS bigint) AS volume
  FROM dirty_bars),
valid AS (
  SELECT * FROM typed
  WHERE open > 0 AND high > 0 AND low > 0 AND close > 0 AND volume >= 0 AND high >= low
    AND isfinite(open) AND isfinite(high) AND isfinite(low) AND isfinite(close))"""

_DEDUP_ORDER = (
    "ORDER BY open ASC NULLS FIRST, high ASC NULLS FIRST, low ASC NULLS FIRST, "
    "close ASC NULLS FIRST, volume ASC NULLS FIRST"
)


def _dedup_of(src: str) -> str:
    return (
        "SELECT symbol, date, open, high, low, close, volume FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY symbol, date {_DEDUP_ORDER}) AS _rn "
        f"FROM {src}) WHERE _rn = 1"
    )


CTE_SILVER_D = f"""deduped AS ({_dedup_of("valid")}),
silver_d0 AS (
  SELECT *, {R("(close - open) / open * 100", 4)} AS daily_return_pct,
         {R("high - low", 4)} AS price_range
  FROM deduped),
silver_d AS (
  SELECT *, coalesce(abs(daily_return_pct) > 50.0, false) AS price_spike_flag FROM silver_d0)"""

CTE_SUMMARY = f"""summary AS (
  SELECT symbol, date, open, high, low, close, volume, daily_return_pct, price_range,
         price_spike_flag,
         {R("avg(close) " + _w(7), 4)} AS ma_7d,
         {R("avg(close) " + _w(30), 4)} AS ma_30d,
         {R("avg(close) " + _w(90), 4)} AS ma_90d
  FROM silver_c)"""

_MOVERS = """movers AS (
  SELECT date, symbol, direction, daily_return_pct, abs_return, close, volume,
         cast(rnk AS integer) AS "rank"
  FROM (
    SELECT *, dense_rank() OVER (PARTITION BY date, direction
                                 ORDER BY abs_return DESC NULLS LAST) AS rnk
    FROM (
      SELECT *, CASE WHEN daily_return_pct > 0 THEN 'GAINER' ELSE 'LOSER' END AS direction,
             abs(daily_return_pct) AS abs_return
      FROM silver_c WHERE NOT price_spike_flag))
  WHERE rnk <= {n})"""
CTE_MOVERS, CTE_MOVERS_3 = _MOVERS.format(n=10), _MOVERS.format(n=3)

CTE_VOLUME_ALL = f"""volume_all AS (
  SELECT *, avg(volume) {_w(30)} AS avg_30d_volume FROM silver_c)"""

CTE_VOLUME = CTE_VOLUME_ALL + """,
volume_an AS (
  SELECT symbol, date, volume, avg_30d_volume, close, daily_return_pct,
         coalesce(volume > avg_30d_volume * 2, false) AS volume_spike
  FROM volume_all WHERE coalesce(volume > avg_30d_volume * 2, false))"""

CTE_VW_SUMMARY = f"""vw_summary AS (
  SELECT g.symbol, g.date, g.open, g.high, g.low, g.close, g.volume,
         {R("g.daily_return_pct", 2)} AS daily_return_pct,
         {R("g.price_range", 2)} AS price_range,
         {R("g.ma_7d", 2)} AS ma_7d,
         {R("g.ma_30d", 2)} AS ma_30d,
         {R("g.ma_90d", 2)} AS ma_90d,
         CASE WHEN g.close > g.ma_30d THEN 'ABOVE'
              WHEN g.close < g.ma_30d THEN 'BELOW' ELSE 'AT' END AS ma30_signal,
         CASE WHEN g.daily_return_pct >= 3 THEN 'STRONG GAIN'
              WHEN g.daily_return_pct >= 1 THEN 'GAIN'
              WHEN g.daily_return_pct <= -3 THEN 'STRONG LOSS'
              WHEN g.daily_return_pct <= -1 THEN 'LOSS' ELSE 'FLAT' END AS performance_label,
         g.price_spike_flag
  FROM summary g)"""

CTE_VW_SPIKES = f"""vw_spikes AS (
  SELECT symbol, date, volume,
         {R("avg_30d_volume", 0)} AS avg_30d_volume,
         {R("volume / avg_30d_volume", 2)} AS volume_ratio,
         {R("daily_return_pct", 2)} AS daily_return_pct,
         close
  FROM volume_an)"""


# The batch of a bar in ``batched_bronze`` (a bar sent again later loses to its first copy).
CTE_BATCHED = """batched AS (
  SELECT *, least(CASE WHEN date < DATE '1995-06-01' THEN 1 WHEN date < DATE '1997-06-01' THEN 2 ELSE 3 END
         + CASE WHEN ascii(right(symbol, 1)) % 4 = 0 AND volume % 10 = 0 THEN 1 ELSE 0 END, 3) AS _b
  FROM clean_bars)"""
# the dirty chain with the batch carried along and first in the order of copies
CTE_DIRTY_B = (
    CTE_DIRTY.replace("low AS _low,", "low AS _low, _b,")
    .replace("FROM clean_bars", "FROM batched")
    .replace("END AS volume\n", "END AS volume, _b\n")
    .replace("close, volume FROM raw_bars", "close, volume, _b FROM raw_bars")
    .replace("try_cast(volume AS bigint) AS volume\n", "try_cast(volume AS bigint) AS volume, _b\n")
)
CTE_SILVER_B = f"""silver_b0 AS (
  SELECT symbol, date, open, high, low, close, volume, cast(_b AS integer) AS _batch_number,
         {R("(close - open) / open * 100", 4)} AS daily_return_pct, {R("high - low", 4)} AS price_range
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date {_DEDUP_ORDER.replace("ORDER BY", "ORDER BY _b,")}) AS _rn FROM valid)
  WHERE _rn = 1),
silver_c AS (
  SELECT *, coalesce(abs(daily_return_pct) > 50.0, false) AS price_spike_flag FROM silver_b0)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_C = (CTE_CLEAN,)
_SC = (CTE_CLEAN, CTE_SILVER_C)
_D = (CTE_CLEAN, CTE_DIRTY)
_SD = (CTE_CLEAN, CTE_DIRTY, CTE_SILVER_D)

_B = (CTE_CLEAN, CTE_BATCHED, CTE_DIRTY_B, CTE_SILVER_B)

_EXPECTED_SQL = "(SELECT unnest(['S00', 'ZZZ']) AS expected_symbol)"

ORACLE_SQL: dict[str, str] = {
    "cast_schema": _with(*_D) + "SELECT * FROM typed",
    "filter_valid": _with(*_D) + "SELECT * FROM valid",
    "dedup": _with(*_D) + _dedup_of("typed"),
    "silver": _with(*_SD) + "SELECT * FROM silver_d",
    "daily_return": _with(*_SC) + "SELECT symbol, date, daily_return_pct FROM silver_c",
    "price_range": _with(*_SC) + "SELECT symbol, date, price_range FROM silver_c",
    "price_spike": _with(*_SC)
    + "SELECT symbol, date, daily_return_pct, price_spike_flag FROM silver_c",
    "moving_average": _with(*_SC, CTE_SUMMARY)
    + "SELECT symbol, date, close, ma_7d, ma_30d, ma_90d FROM summary",
    "volume_spike": _with(*_SC, CTE_VOLUME_ALL)
    + "SELECT symbol, date, volume, avg_30d_volume, "
    "coalesce(volume > avg_30d_volume * 2, false) AS volume_spike FROM volume_all",
    "stock_summary": _with(*_SC, CTE_SUMMARY) + "SELECT * FROM summary",
    "moving_average_segmented": _with(*_SC, CTE_SUMMARY)
    + "SELECT symbol, date, close, ma_7d, ma_30d, ma_90d FROM summary",
    "volume_spike_segmented": _with(*_SC, CTE_VOLUME_ALL)
    + "SELECT symbol, date, volume, avg_30d_volume, "
    "coalesce(volume > avg_30d_volume * 2, false) AS volume_spike FROM volume_all",
    "moving_average_prefix": _with(*_SC, CTE_SUMMARY)
    + "SELECT symbol, date, close, ma_7d, ma_30d, ma_90d FROM summary",
    "volume_spike_prefix": _with(*_SC, CTE_VOLUME_ALL)
    + "SELECT symbol, date, volume, avg_30d_volume, "
    "coalesce(volume > avg_30d_volume * 2, false) AS volume_spike FROM volume_all",
    "top_movers": _with(*_SC, CTE_MOVERS) + "SELECT * FROM movers",
    "top_movers_value_ranks": _with(*_SC, CTE_MOVERS) + "SELECT * FROM movers",
    "top_movers_top3": _with(*_SC, CTE_MOVERS_3) + "SELECT * FROM movers",
    "top_movers_range_ranks": _with(*_SC, CTE_MOVERS_3) + "SELECT * FROM movers",
    "volume_analysis": _with(*_SC, CTE_VOLUME) + "SELECT * FROM volume_an",
    "vw_stock_summary": _with(*_SC, CTE_SUMMARY, CTE_VW_SUMMARY) + "SELECT * FROM vw_summary",
    "vw_top_movers": _with(*_SC, CTE_MOVERS)
    + f"""SELECT date, symbol, direction, {R("daily_return_pct", 2)} AS daily_return_pct,
       {R("close", 2)} AS close, volume, "rank"
FROM movers WHERE "rank" <= 5 ORDER BY date DESC, direction, "rank\"""",
    "vw_volume_spikes": _with(*_SC, CTE_VOLUME, CTE_VW_SPIKES)
    + "SELECT * FROM vw_spikes ORDER BY volume_ratio DESC",
    "sma_7d": _with(*_SC)
    + f"SELECT symbol, date, close, {R('avg(close) ' + _w(7), 4)} AS ma_7d FROM silver_c",
    "sma_30d": _with(*_SC)
    + f"SELECT symbol, date, close, {R('avg(close) ' + _w(30), 4)} AS ma_30d FROM silver_c",
    "crossover": _with(
        *_SC,
        f"""mv AS (SELECT symbol, date, close, {R('avg(close) ' + _w(7), 4)} AS ma_7d,
       {R('avg(close) ' + _w(30), 4)} AS ma_30d FROM silver_c)""",
    )
    + """SELECT symbol, date, close, ma_7d, ma_30d,
       CASE WHEN ma_7d > ma_30d THEN 'GOLDEN CROSS'
            WHEN ma_7d < ma_30d THEN 'DEATH CROSS' ELSE 'NEUTRAL' END AS crossover_signal
FROM mv ORDER BY symbol, date""",
    "crossover_join": _with(
        *_SC,
        f"mv7 AS (SELECT symbol, date, close, {R('avg(close) ' + _w(7), 4)} AS ma_7d FROM silver_c)",
        f"mv30 AS (SELECT symbol, date, close, {R('avg(close) ' + _w(30), 4)} AS ma_30d "
        "FROM silver_c)",
    )
    + """SELECT a.symbol, a.date, a.close, a.ma_7d, b.ma_30d,
       CASE WHEN a.ma_7d > b.ma_30d THEN 'GOLDEN CROSS'
            WHEN a.ma_7d < b.ma_30d THEN 'DEATH CROSS' ELSE 'NEUTRAL' END AS crossover_signal
FROM mv7 a JOIN mv30 b ON a.symbol = b.symbol AND a.date = b.date ORDER BY a.symbol, a.date""",
    "top_gains": _with(*_SC, CTE_SUMMARY, CTE_VW_SUMMARY)
    + """SELECT symbol, date, close, daily_return_pct, performance_label FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol
         ORDER BY daily_return_pct DESC NULLS LAST, date ASC NULLS LAST) AS rn
  FROM vw_summary) WHERE rn <= 5""",
    "top_volume_spikes": _with(*_SC, CTE_VOLUME, CTE_VW_SPIKES)
    + """SELECT symbol, date, volume_ratio, daily_return_pct FROM vw_spikes
ORDER BY volume_ratio DESC NULLS LAST, symbol ASC NULLS LAST, date ASC NULLS LAST LIMIT 5""",
    "latest_signal": _with(*_SC, CTE_SUMMARY, CTE_VW_SUMMARY)
    + """SELECT symbol, max(date) AS latest_date, arg_max(ma30_signal, date) AS ma30_signal,
       arg_max(performance_label, date) AS last_performance
FROM vw_summary GROUP BY symbol ORDER BY symbol""",
    "dq_report": _with(*_SD)
    + f"""SELECT check_name, fail_count,
       CASE WHEN fail_count = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM (
  SELECT 'null_symbols' AS check_name, cast(count(*) AS bigint) AS fail_count
    FROM silver_d WHERE symbol IS NULL
  UNION ALL SELECT 'null_dates', count(*) FROM silver_d WHERE date IS NULL
  UNION ALL SELECT 'negative_prices', count(*) FROM silver_d
    WHERE open <= 0 OR high <= 0 OR low <= 0 OR close <= 0
  UNION ALL SELECT 'high_lt_low', count(*) FROM silver_d WHERE high < low
  UNION ALL SELECT 'duplicates', count(*) FROM (
    SELECT symbol, date FROM silver_d GROUP BY symbol, date HAVING count(*) > 1)
  UNION ALL SELECT 'missing_symbols', count(*) FROM {_EXPECTED_SQL} e
    WHERE NOT EXISTS (SELECT 1 FROM silver_d s WHERE s.symbol = e.expected_symbol)
  UNION ALL SELECT 'low_row_count', count(*) FROM (
    SELECT symbol FROM silver_d GROUP BY symbol HAVING count(*) < 100))""",
    "dq_report_runner": _with(*_SD)
    + """SELECT check_name, fail_count,
       CASE WHEN fail_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT 'null_symbols' AS check_name, cast(count(*) AS bigint) AS fail_count
    FROM silver_d WHERE symbol IS NULL
  UNION ALL SELECT 'null_dates', count(*) FROM silver_d WHERE date IS NULL
  UNION ALL SELECT 'negative_prices', count(*) FROM silver_d
    WHERE open <= 0 OR high <= 0 OR low <= 0 OR close <= 0
  UNION ALL SELECT 'high_lt_low', count(*) FROM silver_d WHERE high < low
  UNION ALL SELECT 'duplicates', count(*) FROM (
    SELECT symbol, date FROM silver_d GROUP BY symbol, date HAVING count(*) > 1)
  UNION ALL SELECT 'low_row_count', count(*) FROM (
    SELECT symbol FROM silver_d GROUP BY symbol HAVING count(*) < 100))""",
    "dq_gate_checks": _with(*_SD)
    + """SELECT check_name, fail_count,
       CASE WHEN fail_count = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM (
  SELECT 'null_symbols' AS check_name, cast(count(*) AS bigint) AS fail_count
    FROM silver_d WHERE symbol IS NULL
  UNION ALL SELECT 'negative_prices', count(*) FROM silver_d WHERE open <= 0 OR close <= 0
  UNION ALL SELECT 'duplicates', count(*) FROM (
    SELECT symbol, date FROM silver_d GROUP BY symbol, date HAVING count(*) > 1))""",
    "dq_duplicates": _with(*_D)
    + "SELECT symbol, date, count(*) AS cnt FROM valid GROUP BY symbol, date HAVING count(*) > 1",
    "dq_low_rows": _with(*_SD)
    + "SELECT symbol, count(*) AS cnt FROM silver_d GROUP BY symbol HAVING count(*) < 530",
    "dq_report_batches": _with(CTE_CLEAN, CTE_BATCHED, CTE_DIRTY_B)
    + f""", resent AS (  -- the bars of the first batch that were sent again in the third
  SELECT symbol, date, open, high, low, close, volume, _b FROM valid
  UNION ALL SELECT symbol, date, open, high, low, close, volume, 3 FROM valid WHERE _b = 1 AND volume % 7 = 0)
SELECT check_name, fail_count,
       CASE WHEN fail_count = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM (
  SELECT 'null_symbols' AS check_name, cast(count(*) AS bigint) AS fail_count
    FROM resent WHERE symbol IS NULL
  UNION ALL SELECT 'null_dates', count(*) FROM resent WHERE date IS NULL
  UNION ALL SELECT 'negative_prices', count(*) FROM resent
    WHERE open <= 0 OR high <= 0 OR low <= 0 OR close <= 0
  UNION ALL SELECT 'high_lt_low', count(*) FROM resent WHERE high < low
  UNION ALL SELECT 'duplicates', count(*) FROM (
    SELECT symbol, date FROM resent GROUP BY symbol, date HAVING count(*) > 1)
  UNION ALL SELECT 'missing_symbols', count(*) FROM {_EXPECTED_SQL} e
    WHERE NOT EXISTS (SELECT 1 FROM resent s WHERE s.symbol = e.expected_symbol)
  UNION ALL SELECT 'low_row_count', count(*) FROM (
    SELECT symbol FROM resent GROUP BY symbol HAVING count(*) < 530))""",
    "scan_csv_multiline": _with(*_C) + "SELECT * FROM clean_bars",
    "consume_bounded": _with(*_C) + "SELECT * FROM clean_bars ORDER BY date, symbol LIMIT 3333",
    "clustered_stock_summary": _with(*_SC, CTE_SUMMARY) + "SELECT * FROM summary",
    "missing_symbols_not_in_named": _with(*_SD)
    + f"""SELECT expected_symbol FROM {_EXPECTED_SQL} e
WHERE expected_symbol NOT IN (SELECT DISTINCT symbol FROM silver_d WHERE symbol IS NOT NULL)""",
    "crossover_edges": _with(
        *_SC,
        f"""mv AS (SELECT symbol, date, close, {R('avg(close) ' + _w(7), 4)} AS ma_7d,
       {R('avg(close) ' + _w(30), 4)} AS ma_30d FROM silver_c)""",
        """st AS (SELECT *, CASE WHEN ma_7d > ma_30d THEN 'GOLDEN CROSS'
            WHEN ma_7d < ma_30d THEN 'DEATH CROSS' ELSE 'NEUTRAL' END AS crossover_signal FROM mv)""",
    )
    + """SELECT * FROM (
  SELECT *, lag(nullif(crossover_signal, 'NEUTRAL') IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date) AS previous_signal
  FROM st)
WHERE crossover_signal <> 'NEUTRAL' AND crossover_signal <> previous_signal""",
    "missing_symbols": _with(*_SD)
    + f"""SELECT expected_symbol FROM {_EXPECTED_SQL} e
WHERE NOT EXISTS (SELECT 1 FROM silver_d s WHERE s.symbol = e.expected_symbol)""",
    "encode_messages": _with(*_C)
    + """SELECT cast(to_json({'symbol': symbol, 'date': cast(date AS varchar),
       'open': cast(open AS varchar), 'high': cast(high AS varchar),
       'low': cast(low AS varchar), 'close': cast(close AS varchar),
       'volume': cast(volume AS varchar)}) AS varchar) AS value FROM clean_bars""",
    "decode_messages": _with(*_C) + "SELECT * FROM clean_bars",
    "scan_csv": _with(*_C) + "SELECT * FROM clean_bars",
    "scan_csv_symbol_map": _with(*_C) + "SELECT * FROM clean_bars",
    "ingest_stream": _with(*_C) + "SELECT * FROM clean_bars",
    "streaming_silver": _with(*_SD)
    + f"""SELECT * FROM silver_d WHERE symbol IS NOT NULL AND date IS NOT NULL
UNION ALL
SELECT *, coalesce(abs(daily_return_pct) > 50.0, false) AS price_spike_flag FROM (
  SELECT *, {R("(close - open) / open * 100", 4)} AS daily_return_pct, {R("high - low", 4)} AS price_range
  FROM valid WHERE symbol IS NULL OR date IS NULL)""",
    "incremental_silver": _with(*_B) + "SELECT * FROM silver_c",
    "incremental_stock_summary": _with(*_B, CTE_SUMMARY) + "SELECT * FROM summary",
    "incremental_marts": _with(*_B, CTE_MOVERS_3, CTE_VOLUME)
    + """SELECT 'mover' AS mart, symbol, date, abs_return AS value, cast("rank" AS bigint) AS "rank" FROM movers
UNION ALL SELECT 'volume', symbol, date, avg_30d_volume, cast(NULL AS bigint) FROM volume_an""",
    "written_stock_summary": _with(*_SC, CTE_SUMMARY) + "SELECT * FROM summary",
    "missing_symbols_not_in": _with(*_SD)
    + f"""SELECT expected_symbol FROM {_EXPECTED_SQL} e
WHERE expected_symbol NOT IN (SELECT DISTINCT symbol FROM silver_d)""",
}
