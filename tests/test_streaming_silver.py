"""The stateful silver stream: copies, late rows, restart, replay."""

import json
import os

from pyspark.sql import functions as F

from ohlcflow.plans.silver import to_silver
from ohlcflow.plans.storage import scratch_path
from ohlcflow.schemas import BAR_FIELDS
from ohlcflow.sources.messages import encode_messages, written_with_key
from ohlcflow.streaming.ingest import message_stream
from ohlcflow.streaming.silver import DRAINED, HAS_KEY, STATE_STORE, late_bars, run_silver_stream, silver_stream, unkeyed_bars, valid_bars


class Feed:
    def __init__(self, spark, raw_bars):
        self.spark, self.raw_bars, self.n = spark, raw_bars, 0
        self.src, self.silver, self.ckpt = (scratch_path(spark, n) for n in ("feed", "feed-silver", "feed-ckpt"))
        os.makedirs(self.src)

    def send(self, *bars):
        values = [r["value"] for r in encode_messages(self.raw_bars(list(bars))).collect()]
        with open(f"{self.src}/part-{self.n:03d}.json", "w") as f:
            f.write("\n".join(values) + "\n")
        self.n += 1

    def run(self, **options):
        messages = message_stream(self.spark, "files", self.src, max_per_trigger=1)
        return run_silver_stream(self.spark, messages, self.silver, self.ckpt, **options)


def bar(symbol, date, close="2", open="1"):
    return (symbol, date, open, "9", "0.5", close, "10")


def rows(df):
    return sorted((r.symbol or "", str(r.date), r.close) for r in df.collect())


def test_copies_in_one_batch_across_batches_and_after_a_restart(spark, raw_bars):
    feed = Feed(spark, raw_bars)
    feed.send(bar("A", "2024-01-05"), bar("A", "2024-01-05"), bar("B", "2024-01-05"))
    feed.send(bar("A", "2024-01-05", "3"), bar("A", "2024-01-06"))  # a copy with another payload: the first stays
    run = feed.run()
    want = [("A", "2024-01-05", 2.0), ("A", "2024-01-06", 2.0), ("B", "2024-01-05", 2.0)]
    assert rows(run.table) == want and run.late_rows == 0
    # a new query from the same checkpoint: the state knows the keys
    feed.send(bar("B", "2024-01-05", "4"), bar("A", "2024-01-06"), bar("C", "2024-01-06"))
    run = feed.run()
    assert rows(run.table) == [*want, ("C", "2024-01-06", 2.0)]
    assert run.state_rows == 4
    assert feed.run().table.count() == 4  # nothing new
    derived = run.table.select("daily_return_pct", "price_range", "price_spike_flag", "_layer").distinct().collect()
    assert [tuple(r) for r in derived] == [(100.0, 8.5, True, "silver")]


def test_late_rows_are_counted_and_found(spark, raw_bars):
    feed = Feed(spark, raw_bars)
    feed.send(bar("A", "2024-01-05"))
    feed.send(bar("A", "2024-03-01"))
    feed.send(bar("A", "2024-02-25"))  # within the delay
    feed.send(bar("L", "2024-01-06"), bar("A", "2024-01-05", "5"))  # more than ten days behind
    run = feed.run(delay="10 days")
    assert rows(run.table) == [("A", "2024-01-05", 2.0), ("A", "2024-02-25", 2.0), ("A", "2024-03-01", 2.0)]
    assert run.late_rows == 2
    assert run.state_rows <= 2  # the January key has left the state
    everything = valid_bars(spark.read.text(feed.src))
    assert rows(late_bars(everything, run.table)) == [("L", "2024-01-06", 2.0)]


def test_rows_without_a_key_pass_and_invalid_ones_do_not(spark, raw_bars):
    feed = Feed(spark, raw_bars)
    feed.send(bar(None, "2024-01-05"), bar(None, "2024-01-05"), bar("A", "no date"), bar("A", "2024-01-05", "-1"), bar("A", "2024-01-05"))
    run = feed.run()
    assert rows(run.table) == [("", "2024-01-05", 2.0)] * 2 + [("A", "2024-01-05", 2.0), ("A", "None", 2.0)]
    only = Feed(spark, raw_bars)
    only.send(bar(None, "2024-01-05"), bar("A", "2024-01-05"))
    assert rows(only.run(keep_unkeyed=False).table) == [("A", "2024-01-05", 2.0)]


def test_stream_equals_the_batch_job(spark, sample_bars):
    feed = Feed(spark, None)
    feed.raw_bars = lambda x: x[0]
    for part in (sample_bars.filter("symbol = 'NORD'"), sample_bars, sample_bars.limit(4)):
        feed.send(part)
    columns = [*BAR_FIELDS, "daily_return_pct", "price_range", "price_spike_flag"]
    got, want = feed.run(delay="30 days").table.select(*columns), to_silver(sample_bars).select(*columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_the_operator_is_stateful_and_bounded(spark):
    stream = spark.readStream.format("rate").load().select(F.lit("{}").alias("value"))
    plan = silver_stream(stream, "3 days")._jdf.queryExecution().logical().toString()
    assert "DeduplicateWithinWatermark" in plan and "EventTimeWatermark" in plan


def test_rows_without_a_key_are_picked_before_prices_are_typed(spark, raw_bars):
    messages = encode_messages(
        raw_bars(
            [
                bar("A", "2024-01-01"), bar(None, "2024-01-01"), bar("A", "2024-13-01"), bar("A", None), bar("", "2024-01-02"),
                bar(None, "no date", close="n/a"), bar(None, None), bar(None, "2024-01-03", open="-1"),
            ]
        )
    )
    got = unkeyed_bars(messages)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, valid_bars(messages).filter(f"NOT ({HAS_KEY})").collect()))
    assert got.count() == 4
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    condition = next(x for x in plan.splitlines() if "Filter" in x and "isnull(" in x)
    assert "try_cast(" in condition and condition.index("isnull(") < condition.index("try_cast(")


def test_state_is_on_disk_unless_the_session_or_the_checkpoint_says_otherwise(spark, raw_bars):
    key = "spark.sql.streaming.stateStore.providerClass"
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"

    def provider(feed, batch):
        with open(f"{feed.ckpt}/offsets/{batch}") as f:
            return json.loads(f.read().splitlines()[1])["conf"][key]

    feeds = {}
    for chosen in (None, heap):
        feed = feeds[chosen] = Feed(spark, raw_bars)
        feed.send(bar("A", "2024-01-05"), bar("A", "2024-01-05"), bar("B", "2024-01-05"))
        if chosen:
            spark.conf.set(key, chosen)
        try:
            assert feed.run().state_rows == 2
        finally:
            spark.conf.unset(key)
        assert provider(feed, 0) == (chosen or STATE_STORE[key])
        assert all(spark.conf.get(k, None) is None for k in [*STATE_STORE, *DRAINED])  # the session keeps its settings
    feed = feeds[heap]  # a stream that the earlier default began goes on from its state
    feed.send(bar("B", "2024-01-05", "3"), bar("C", "2024-01-05"))
    run = feed.run()
    assert rows(run.table) == [(s, "2024-01-05", 2.0) for s in "ABC"] and run.state_rows == 3
    assert provider(feed, max(int(x) for x in os.listdir(f"{feed.ckpt}/offsets") if x.isdigit())) == heap
    assert Feed.run(feed).state_rows == 3  # nothing new: the count holds


def test_messages_that_show_their_key_are_left_out_unparsed(spark):
    rest = '"open":"1","high":"9","low":"0.5","close":"2","volume":"10"'
    shown = [f'{{"symbol":"{s}","date":"{d}",{rest}}}' for s in ("A", "Ä b") for d in ("2024-01-31", "2024-02-28", "1999-12-30")]
    others = [
        f'{{"symbol":{s},"date":{d},{rest}}}'
        for s in ('"A"', '""', "null", "7", r'"\u0041"', r'"a\"b"', "{}", '["x"]')
        for d in ('"2024-02-29"', '"2023-02-29"', '"2024-04-31"', '"2024-13-01"', '"2024-1-01"', '"0000-01-01"', '" 2024-01-01"', '"x"', '""', "null", "20240101")
    ]
    odd = [
        f'{{"date":"2024-01-01","symbol":"A",{rest}}}', f'{{{rest},"symbol":"A"}}', f'{{"symbol":"A",{rest}}}',
        f'{{"symbol":"A","date":"2024-01-01",{rest},"symbol":null}}', f'{{"symbol":"A","date":"2024-01-01",{rest},"date":"x"}}',
        f'{{"symbol":"A","date":"2024-01-01",{rest},"x":{{"symbol":null}}}}', f'{{"x":{{"symbol":"A","date":"2024-01-01"}},{rest}}}',
        f'{{"symbol": "A", "date": "2024-01-01", {rest}}}', f' {{"symbol":"A","date":"2024-01-01",{rest}}} ',
        f'{{"symbol":"A","date":"2024-01-01",{rest}}}x', f'{{"symbol":"A","date":"2024-01-01",{rest}', f'{{"symbol":"A","date":"2024-01-01",{rest}}}\n',
        f'{{"symbol":"A\tB","date":"2024-01-01",{rest}}}', '{"symbol":"A","date":"2024-01-01","open":null}', "{}", "", None,
    ]
    messages = spark.createDataFrame([(x,) for x in [*shown, *others, *odd]], "value string")
    told = {r.value for r in messages.filter(written_with_key()).collect()}
    assert told >= set(shown) and f'{{"symbol":"A","date":"2024-02-29",{rest}}}' not in told
    text = F.col("date").cast("string")  # the year 0 is no Python date
    got, want = (df.withColumn("date", text).collect() for df in (unkeyed_bars(messages), valid_bars(messages).filter(f"NOT ({HAS_KEY})")))
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(want) > 50
    # bytes, as topics have them
    coded = messages.select(F.encode("value", "UTF-8").alias("value"))
    assert coded.filter(written_with_key()).count() == messages.filter(written_with_key()).count()
    parsed = valid_bars(messages.filter(written_with_key()))
    assert parsed.filter(f"NOT ({HAS_KEY})").isEmpty() and not parsed.isEmpty()
    plan = unkeyed_bars(messages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json") < plan.rindex("RLIKE(")  # the parse is above


def test_no_store_is_left_open_after_a_run(spark, raw_bars):
    local = spark._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())

    def stores():
        return {f"{d}/{x}" for d, names, _ in os.walk(local) for x in names if x.startswith("StateStoreId")}

    feed, before = Feed(spark, raw_bars), stores()
    for day in ("2024-01-05", "2024-01-06"):
        feed.send(bar("A", day), bar("A", "2024-01-05"))
        assert rows(feed.run().table)[-1] == ("A", day, 2.0)
        assert not stores() - before
    assert feed.run().state_rows == 2
