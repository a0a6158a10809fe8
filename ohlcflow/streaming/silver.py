"""Message stream -> silver table, deduplicated on the way.

The batch job rebuilds silver from all of bronze; this stream keeps it up to
date bar by bar. Messages are decoded, typed and checked as in the batch job;
bars are then deduplicated by a stateful operator
(``dropDuplicatesWithinWatermark`` on symbol and date). Its state holds the
keys of the last ``delay`` of event time (the bar's date) only, lives in the
checkpoint and is restored from there after a restart. A new stream keeps it in
RocksDB (:data:`STATE_STORE`): a key costs bytes on the executors' disks, not
some hundred bytes of heap in each version, and a restart fetches files instead
of building maps.

* The first copy of a bar to arrive is kept, as the batch job keeps the
  earliest ingested one. Of copies with different payloads that arrive in the
  same micro-batch any one is kept.
* A bar dated more than ``delay`` before the latest bar of earlier
  micro-batches is late: it could not be told from a copy, so it is not
  written. ``SilverRun.late_rows`` counts such rows; :func:`late_bars` finds
  them in bronze, and the incremental job (:mod:`ohlcflow.plans.incremental`)
  takes them up.
* A row without symbol or date is no bar that could have a copy. Such rows
  pass as they are, for the quality gate to report; they are a second, small
  branch of the query and can be left out (``keep_unkeyed=False``).

Every micro-batch overwrites its own ``(_stream, _batch_number)`` partition, so
a replay after a failure (from the state of the batch before it) replaces what
it wrote.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.expressions import parse_date
from ..operators.clean import cast_schema, filter_valid_prices
from ..operators.features import add_daily_return, add_price_range, add_price_spike_flag
from ..plans.storage import path_exists
from ..schemas import MAX_PRICE_SPIKE, SILVER_DERIVED_FIELDS, SILVER_LAYER, TYPED_BAR_SCHEMA
from ..sources.messages import decode_messages, written_with_key
from ..sources.tables import read_table
from .ingest import overwrite_batch, stream_id

HAS_KEY = "symbol IS NOT NULL AND date IS NOT NULL"
_AUDIT = "_processed_at timestamp, _layer string, _batch_number int, _stream string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: State store of a stream whose session names none. All stores of an executor share one
#: bounded cache (``maxMemoryUsageMB``); none counts its rows, which costs a lookup at every
#: write. A stream started with another provider goes on with it: its checkpoint names it.
STATE_STORE = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
#: A run that drains what is there closes each store when its task ends: stores of ended
#: runs would keep their memory, and some 5 MB of disk each, until the next maintenance.
DRAINED = {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}
_STARTING = Lock()


@contextmanager
def state_store(spark: SparkSession, drained: bool) -> Iterator[None]:
    """:data:`STATE_STORE` (and :data:`DRAINED`) hold for streams started inside, which take
    a copy of the session's settings; what the session sets itself comes first."""
    with _STARTING:
        chosen = spark.conf.get(_PROVIDER, None) is not None
        settings = {} if chosen else {**STATE_STORE, **(DRAINED if drained else {})}
        ours = {k: v for k, v in settings.items() if spark.conf.get(k, None) is None}
        for k, v in ours.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k in ours:
                spark.conf.unset(k)


def valid_bars(messages: DataFrame) -> DataFrame:
    """Typed bars of a message stream or table that pass the price checks."""
    return filter_valid_prices(cast_schema(decode_messages(messages)))


def unkeyed_bars(messages: DataFrame) -> DataFrame:
    """The rows of :func:`valid_bars` without symbol or date.

    They are few: messages that show their key in the text are left out unparsed, and of
    the others the rows are picked before the prices are typed and checked.
    """
    decoded = decode_messages(messages.filter(~written_with_key()))
    return filter_valid_prices(cast_schema(decoded.filter(F.col("symbol").isNull() | parse_date("date").isNull())))


def silver_stream(
    messages: DataFrame,
    delay: str = "7 days",
    max_spike: float = MAX_PRICE_SPIKE,
    keep_unkeyed: bool = True,
) -> DataFrame:
    """The streaming silver rows (no audit columns) of a streaming ``messages``."""
    valid = valid_bars(messages)
    rows = (
        valid.filter(HAS_KEY)
        .withColumn("_event_time", F.col("date").cast("timestamp"))
        .withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(["symbol", "date"])
        .drop("_event_time")
    )
    if keep_unkeyed:
        rows = rows.unionByName(unkeyed_bars(messages))
    return add_price_spike_flag(add_price_range(add_daily_return(rows)), max_spike)


def start_silver_stream(
    messages: DataFrame,
    silver_path: str,
    checkpoint_path: str,
    delay: str = "7 days",
    max_spike: float = MAX_PRICE_SPIKE,
    keep_unkeyed: bool = True,
    fmt: str = "parquet",
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the messages -> silver stream; drains what is there unless ``processing_time`` is given."""
    stream = stream_id(messages.sparkSession, checkpoint_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        audit = {
            "_processed_at": F.current_timestamp(),
            "_layer": F.lit(SILVER_LAYER),
            "_batch_number": F.lit(int(batch_id) + 1).cast("int"),
            "_stream": F.lit(stream),
        }
        overwrite_batch(batch.withColumns(audit), silver_path, fmt)

    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    writer = (
        silver_stream(messages, delay, max_spike, keep_unkeyed)
        .writeStream.outputMode("append")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**trigger)
    )
    with state_store(messages.sparkSession, drained=not processing_time):
        return writer.start()


@dataclass
class SilverRun:
    """The silver table after a run, the rows that its (at most 100 last) micro-batches
    report as dropped for being late, and the checkpoint."""

    table: DataFrame
    late_rows: int
    checkpoint_path: str

    @property
    def state_rows(self) -> int:
        """Keys held in state, counted in the checkpoint when asked for."""
        spark = self.table.sparkSession
        if not path_exists(spark, f"{self.checkpoint_path}/state/0"):
            return 0
        return spark.read.format("statestore").load(self.checkpoint_path).count()


def run_silver_stream(
    spark: SparkSession, messages: DataFrame, silver_path: str, checkpoint_path: str, fmt: str = "parquet", **options
) -> SilverRun:
    """Drain the available messages into silver (``options``: see :func:`start_silver_stream`)."""
    query = start_silver_stream(messages, silver_path, checkpoint_path, fmt=fmt, **options)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    states = [op for progress in query.recentProgress for op in progress["stateOperators"]]
    return SilverRun(
        read_silver(spark, silver_path, fmt),
        sum(op["numRowsDroppedByWatermark"] for op in states),
        checkpoint_path,
    )


def read_silver(spark: SparkSession, silver_path: str, fmt: str = "parquet") -> DataFrame:
    """The streamed silver table; empty if nothing was written yet."""
    schema = StructType([*TYPED_BAR_SCHEMA.fields, *SILVER_DERIVED_FIELDS, *StructType.fromDDL(_AUDIT).fields])
    if not path_exists(spark, silver_path):
        return spark.createDataFrame([], schema)
    return read_table(spark, silver_path, schema, fmt)


def late_bars(bars: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows of ``bars`` (valid, typed) whose key silver does not have."""
    return bars.filter(HAS_KEY).join(silver.select("symbol", "date"), ["symbol", "date"], "left_anti")
