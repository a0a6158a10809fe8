"""Message stream -> bronze table with Structured Streaming.

The source is any streaming DataFrame with a ``value`` column: a directory of
JSON-lines files (``format("text")``) or a Kafka topic (``format("kafka")``,
when its connector is on the classpath). Each micro-batch is decoded with
``from_json`` on the executors and written by ``foreachBatch``:

* audit columns ``_ingested_at`` (batch time), ``_batch_number`` (micro-batch
  id + 1, monotone across restarts because it comes from the checkpoint) and
  ``_source``;
* the bronze table is partitioned by ``(_stream, _batch_number)``, where
  ``_stream`` is derived from the checkpoint location; each batch overwrites
  only its own partition (dynamic partition overwrite), so a batch replayed
  after a failure replaces its earlier output instead of duplicating it
  (effectively exactly-once on top of the at-least-once ``foreachBatch``
  contract), while a run with a new checkpoint appends new partitions
  instead of overwriting earlier runs' batches;
* messages that are not JSON bar objects go to a rejects table, by default
  ``<bronze_path>_rejects``.

``trigger(availableNow=True)`` drains what is available and stops (the
reference stops after 10 s without messages); batch size is bounded with
``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.storage import path_exists, qualified_path
from ..schemas import BRONZE_SCHEMA, BRONZE_SOURCE
from ..sources.messages import decode_messages, message_rejects
from ..sources.tables import read_table


def message_stream(
    spark: SparkSession,
    source: str = "files",
    path: str | None = None,
    max_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A streaming DataFrame with a ``value`` column.

    ``source="files"``: JSON lines under ``path`` (``maxFilesPerTrigger``).
    ``source="kafka"``: pass ``kafka.bootstrap.servers`` and ``subscribe`` in
    ``options``; reads from the earliest offset by default
    (``maxOffsetsPerTrigger``).
    """
    opts = dict(options or {})
    if source == "files":
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
        return reader.options(**opts).load(path)
    if source == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        if max_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
        return spark.readStream.format("kafka").options(**opts).load().select("value")
    raise ValueError(f"unknown message source {source!r}")


def stream_id(spark: SparkSession, checkpoint_path: str) -> str:
    """Stable id of a stream: a hash of its qualified checkpoint location."""
    return hashlib.sha1(qualified_path(spark, checkpoint_path).encode()).hexdigest()[:12]


def bronze_batch(
    batch: DataFrame, batch_id: int, source_label: str = BRONZE_SOURCE, stream: str = "default"
) -> DataFrame:
    """Decode one micro-batch and add the bronze audit columns."""
    return decode_messages(batch).withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_batch_number": F.lit(int(batch_id) + 1).cast("int"),
            "_source": F.lit(source_label),
            "_stream": F.lit(stream),
        }
    )


def overwrite_batch(df: DataFrame, path: str, fmt: str) -> None:
    """Replace the ``(_stream, _batch_number)`` partitions that ``df`` has rows of."""
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_stream", "_batch_number")
        .save(path)
    )


def default_rejects_path(bronze_path: str) -> str:
    """A folder beside the bronze table."""
    return f"{bronze_path.rstrip('/')}_rejects"


def ingest_stream(
    messages: DataFrame,
    bronze_path: str,
    checkpoint_path: str,
    rejects_path: str | None = None,
    source_label: str = BRONZE_SOURCE,
    fmt: str = "parquet",
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the messages -> bronze stream; returns the running query."""
    rejects_path = rejects_path or default_rejects_path(bronze_path)
    stream = stream_id(messages.sparkSession, checkpoint_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            overwrite_batch(
                bronze_batch(batch, batch_id, source_label, stream), bronze_path, fmt
            )
            rejects = message_rejects(batch).withColumns(
                {
                    "_batch_number": F.lit(int(batch_id) + 1).cast("int"),
                    "_stream": F.lit(stream),
                }
            )
            overwrite_batch(rejects, rejects_path, fmt)
        finally:
            batch.unpersist()

    writer = messages.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_path
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_ingest(
    spark: SparkSession,
    messages: DataFrame,
    bronze_path: str,
    checkpoint_path: str,
    rejects_path: str | None = None,
    source_label: str = BRONZE_SOURCE,
    fmt: str = "parquet",
) -> DataFrame:
    """Drain the available messages into bronze, then return the bronze table."""
    q = ingest_stream(messages, bronze_path, checkpoint_path, rejects_path, source_label, fmt)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if not path_exists(spark, bronze_path):
        return spark.createDataFrame([], BRONZE_SCHEMA)
    return read_table(spark, bronze_path, BRONZE_SCHEMA, fmt)
