"""Incremental layers equal a full rebuild after every increment."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ohlcflow.operators.marts import stock_summary, top_movers, volume_analysis
from ohlcflow.plans.incremental import IncrementalLayers
from ohlcflow.plans.silver import to_silver
from ohlcflow.plans.storage import path_exists, scratch_path
from ohlcflow.schemas import BRONZE_SCHEMA

WINDOWS = [2, 4]


@pytest.fixture
def bronze_of(spark):
    def make(rows):
        """(symbol, date, close, volume, batch) rows as bronze."""
        full = [(s, d, "8", "99", "1", c, v, None, b, "t", "s") for s, d, c, v, b in rows]
        df = spark.createDataFrame(full, BRONZE_SCHEMA)
        return df.withColumn("_ingested_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("_batch_number")))

    return make


def _same(a, b):
    columns = sorted(c for c in a.columns if c != "_processed_at")
    assert columns == sorted(c for c in b.columns if c != "_processed_at")
    assert Counter(map(repr, a.select(*columns).collect())) == Counter(map(repr, b.select(*columns).collect()))


def check(layers, bronze):
    silver = to_silver(bronze)
    _same(layers.table("silver"), silver)
    _same(layers.table("stock_summary"), stock_summary(silver, WINDOWS))
    _same(layers.table("volume_analysis"), volume_analysis(silver))
    _same(layers.table("top_movers"), top_movers(silver, 2))


def layers_at(spark, halo=None):
    layers = IncrementalLayers(spark, scratch_path(spark, "inc"), WINDOWS, top_n=2)
    if halo:
        layers.halo = halo
    return layers


def test_random_increments_equal_the_rebuild(spark, bronze_of):
    rng, rows = random.Random(6), []
    for batch in (1, 2, 3):
        for _ in range(70):
            day = rng.choice([f"2024-{m:02d}-{d:02d}" for m in range(batch, batch + 2) for d in (1, 9, 17, 25)] + ["2024-01-02", "x"])
            rows.append((rng.choice(["A", "B", "C", "", None]), day, str(rng.choice([7, 8, 8.5, 9, 40, -1])), str(rng.choice([1, 2, 300])), batch))
        rows += rng.sample(rows, 5)
    rows += [(s, d, c, v, 3) for s, d, c, v, b in rows if b == 1][:20]  # sent again
    bronze = bronze_of(rows)
    layers = layers_at(spark)
    for batch in (1, 2, 3):
        assert layers.apply(bronze.filter(F.col("_batch_number") <= batch)).increment == batch
        check(layers, bronze.filter(F.col("_batch_number") <= batch))
    assert layers.apply(bronze) is None


def test_new_bars_read_the_tail_and_not_the_history(spark, bronze_of):
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 9) for d in range(1, 28)]
    first = [(s, d, "9", "5", 1) for s in "AB" for d in days[:-1]]
    bronze = bronze_of([*first, ("A", days[-1], "10", "50", 2)])
    layers = layers_at(spark)
    layers.apply(bronze.filter("_batch_number = 1"))
    report = layers.apply(bronze)
    check(layers, bronze)
    assert (report.new_rows, report.changed_rows, report.appended_series, report.revised_series) == (1, 1, 1, 0)
    assert report.series_rows_read == layers.halo + 1  # of 215 bars of the symbol
    assert report.stored_rows_read == 2 * 26  # the one month of silver
    assert report.periods == {"silver": ["2024-08"], "stock_summary": ["2024-08"]}


def test_a_late_bar_reaches_a_window_s_length_behind_it(spark, bronze_of):
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 13) for d in range(1, 28)]
    first = [("A", d, str(8 + i % 3), "5", 1) for i, d in enumerate(days) if i != 3]
    bronze = bronze_of([*first, ("A", days[3], "30", "500", 2)])
    layers = layers_at(spark)
    layers.apply(bronze.filter("_batch_number = 1"))
    report = layers.apply(bronze)
    check(layers, bronze)
    assert (report.revised_series, report.changed_rows) == (1, 1)
    assert report.periods["stock_summary"] == ["2024-01", "2024-02"]  # 29 rows behind the bar


def test_a_spike_that_vanishes_leaves_no_row_behind(spark, bronze_of):
    days = [f"2024-01-{d:02d}" for d in range(1, 20)]
    bronze = bronze_of([*[("A", d, "9", "5", 1) for d in days], ("A", "2024-03-01", "9", "20", 1)] + [("A", f"2024-02-{d:02d}", "9", "90", 2) for d in range(1, 20)])
    layers = layers_at(spark)
    layers.apply(bronze.filter("_batch_number = 1"))
    assert layers.table("volume_analysis").filter("date = '2024-03-01'").count() == 1
    layers.apply(bronze)
    check(layers, bronze)
    assert layers.table("volume_analysis").filter("date = '2024-03-01'").count() == 0
    assert not path_exists(spark, f"{layers.path('volume_analysis')}/_period=2024-03")


def test_an_increment_that_died_is_taken_up_again(spark, bronze_of, monkeypatch):
    bronze = bronze_of([("A", "2024-01-01", "9", "5", 1), ("B", "2024-01-02", "9", "5", 2), ("B", "2024-02-02", "9", "5", 3)])
    layers = layers_at(spark)
    layers.apply(bronze.filter("_batch_number = 1"))

    def dies(*a, **k):
        raise OSError("lost")

    # before the results were complete, and while they were published
    for step, batch in (("_averages", 2), ("_publish", 2), ("_publish", 3)):
        with monkeypatch.context() as m:
            m.setattr(layers, step, dies)
            with pytest.raises(OSError):
                layers.apply(bronze.filter(F.col("_batch_number") <= batch))
        if step == "_publish":
            layers.apply(bronze.filter(F.col("_batch_number") <= batch))
            check(layers, bronze.filter(F.col("_batch_number") <= batch))


def test_only_new_batches_are_read(spark, bronze_of):
    path = scratch_path(spark, "inc-bronze")
    bronze_of([("A", "2024-01-01", "9", "5", 1), ("B", "2024-01-02", "9", "5", 2)]).write.partitionBy("_stream", "_batch_number").parquet(path)
    from ohlcflow.plans.incremental import _in_batches

    plan = spark.read.schema(BRONZE_SCHEMA).parquet(path).filter(_in_batches([("s", 2)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "_batch_number" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert plan.count() == 1


def test_batches_of_the_bronze_share_one_aggregation(spark, monkeypatch):
    from scales import SF_SMALL
    from ohlcflow import queries as Q

    seen = []
    monkeypatch.setattr(Q, "dirty_bars", lambda bars, own=Q.dirty_bars: seen.append(bars._jdf.queryExecution().optimizedPlan().toString()) or own(bars))
    rows = Q.batched_bronze(spark, SF_SMALL)
    assert len(seen) == 3 and not any("Aggregate" in plan for plan in seen)
    assert {r[0] for r in rows.select("_batch_number").distinct().collect()} == {1, 2, 3}


def test_months_are_merged_by_one_shuffle_and_moved_into_place(spark, bronze_of, monkeypatch):
    from ohlcflow.plans import incremental

    monkeypatch.setattr(incremental, "ROWS_PER_FILE", 5)  # several files a month
    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 2) for d in range(1, 10)]
    bronze = bronze_of([(s, d, "9", "5", 1) for s in ("A", "B", "C", None) for d in days[::2]] + [("A", d, "8", "70", 2) for d in days])
    layers, plans, own = layers_at(spark), [], IncrementalLayers._merged
    monkeypatch.setattr(layers, "_merged", lambda *a: plans.append(own(layers, *a)) or plans[-1])
    layers.apply(bronze.filter("_batch_number = 1"))
    layers.apply(bronze)
    check(layers, bronze)
    text = plans[1]._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Sort" not in text.split("Exchange")[1]
    for name in ("silver", "stock_summary"):
        assert path_exists(spark, f"{layers.path(name)}/_period=2024-02") and not path_exists(spark, f"{layers._staged(2, name)}/_period=2024-02")
    layers._publish(2)  # repeated: nothing is left to move
    check(layers, bronze)
