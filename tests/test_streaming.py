import os

from pyspark.sql import functions as F

from ohlcflow.operators.clean import cast_schema
from ohlcflow.plans.storage import scratch_path
from ohlcflow.schemas import BAR_FIELDS
from ohlcflow.sources.messages import encode_messages
from ohlcflow.streaming.ingest import message_stream, run_ingest


def test_stream_to_bronze_batches_and_restart(spark, sample_bars):
    src = scratch_path(spark, "stream-src")
    os.makedirs(src)
    enc = [r["value"] for r in encode_messages(cast_schema(sample_bars)).collect()]
    for i in range(3):
        with open(f"{src}/part-{i}.json", "w") as f:
            f.write("\n".join(enc[i * 3:(i + 1) * 3]) + ("\nnot json\n" if i == 0 else "\n"))
    bronze, ckpt, rej = (scratch_path(spark, n) for n in ("bronze", "ckpt", "rejects"))

    def run():
        return run_ingest(spark, message_stream(spark, "files", src, max_per_trigger=1), bronze, ckpt, rej)

    b = run()
    assert b.count() == 7
    assert sorted(r["_batch_number"] for r in b.select("_batch_number").distinct().collect()) == [1, 2, 3]
    assert b.filter(F.col("_source") != "kafka").count() == 0
    assert b.filter(F.col("_ingested_at").isNull()).count() == 0
    assert spark.read.parquet(rej).count() == 1
    same = cast_schema(b).select(*BAR_FIELDS)
    assert same.exceptAll(cast_schema(sample_bars)).count() == 0

    # restart without new files: nothing is added
    assert run().count() == 7
    # a new file becomes batch 4
    with open(f"{src}/part-9.json", "w") as f:
        f.write(enc[0] + "\n")
    b2 = run()
    assert b2.count() == 8 and b2.filter("_batch_number = 4").count() == 1


def test_new_checkpoint_appends(spark, sample_bars):
    """A second run with its own checkpoint adds its batches next to the first
    run's (batch numbers restart at 1 but live under another stream id)."""
    src = scratch_path(spark, "stream-src2")
    os.makedirs(src)
    enc = [r["value"] for r in encode_messages(cast_schema(sample_bars)).collect()]
    with open(f"{src}/part-0.json", "w") as f:
        f.write("\n".join(enc) + "\n")
    bronze = scratch_path(spark, "bronze2")
    for ckpt in (scratch_path(spark, "ckpt-a"), scratch_path(spark, "ckpt-b")):
        b = run_ingest(spark, message_stream(spark, "files", src), bronze, ckpt)
    assert b.count() == 14
    assert b.select("_stream").distinct().count() == 2
    assert sorted(r[0] for r in b.select("_batch_number").distinct().collect()) == [1]


def test_replayed_batch_is_idempotent(spark, sample_bars):
    from ohlcflow.streaming.ingest import overwrite_batch, bronze_batch

    msgs = encode_messages(cast_schema(sample_bars))
    path = scratch_path(spark, "bronze-replay")
    for _ in range(2):  # the same batch id written twice (a replay)
        overwrite_batch(bronze_batch(msgs, 0), path, "parquet")
    overwrite_batch(bronze_batch(msgs.limit(2), 1), path, "parquet")
    assert spark.read.parquet(path).count() == 7 + 2


def test_rejects_are_kept_without_a_path(spark, sample_bars):
    src = scratch_path(spark, "stream-src3")
    os.makedirs(src)
    enc = [r["value"] for r in encode_messages(cast_schema(sample_bars)).collect()]
    with open(f"{src}/part-0.json", "w") as f:
        f.write("\n".join([*enc, "not json"]) + "\n")
    bronze = scratch_path(spark, "bronze3")
    assert run_ingest(spark, message_stream(spark, "files", src), bronze, scratch_path(spark, "ckpt3")).count() == 7
    assert [r["value"] for r in spark.read.parquet(f"{bronze}_rejects").collect()] == ["not json"]
