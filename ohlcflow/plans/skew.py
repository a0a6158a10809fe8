"""Trailing ROWS-frame aggregates that stay exact when one series is huge.

A window ``PARTITION BY symbol ORDER BY date ROWS n-1 PRECEDING`` sends each
symbol to one task. Deduplicated daily bars keep that bounded (one row per
symbol and day), but a feed that is not unique on (symbol, date), e.g. ticks,
can put a third of all rows into one symbol. This module splits every
series into blocks of ``block_rows`` consecutive rows and copies the last
``n-1`` rows of each block into the next one ("halo"); each block is an
ordinary window partition, and halo rows are dropped after the window.
Every frame sees exactly the rows, in the order, of the unsplit window, so
the results are identical.

The row number inside a series is itself computed without a per-series
task: the rows are range-partitioned on the full ordering, so Spark's
sampled bounds split a hot key into partitions of similar size; a row's
number is its position inside its partition plus the key's row count in
earlier partitions (a small per-(partition, key) count table with running
sums, joined back; AQE broadcasts it when the measured table is small).

Work per task is bounded by ``block_rows + n - 1`` rows in the block window
and by one range partition in the numbering step, whatever the key
distribution. (An explicit ``bucket`` column instead numbers per
(key, bucket): one job less, but a crowded bucket is numbered in one task.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from .storage import checkpoint_root

DEFAULT_BLOCK_ROWS = 1_000_000
# Above this many rows in one series, "auto" switches to the segmented plan.
DEFAULT_HOT_ROWS = 5_000_000


def longest_series(df: DataFrame, key: str = "symbol") -> int:
    """Rows in the largest series: a partial/final count per key and a global
    max; one number reaches the driver."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return int(n or 0)


def should_segment(segmented, df: DataFrame, key: str = "symbol", hot_rows: int = DEFAULT_HOT_ROWS) -> bool:
    """Resolve ``segmented`` = True / False / "auto" (measure the longest series)."""
    if segmented == "auto":
        return longest_series(df, key) > hot_rows
    return bool(segmented)


def default_bucket(df: DataFrame, order: str, days: int = 31) -> Column:
    """A coarse bucket of the order column for the ``bucket=`` numbering:
    ``days``-day slices of a date or timestamp, the value itself otherwise."""
    dtype = df.schema[order].dataType
    if isinstance(dtype, DateType):
        return F.floor(F.unix_date(F.col(order)) / days)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.floor(F.unix_seconds(F.col(order).cast("timestamp")) / (86400 * days))
    return F.col(order)


def series_row_number(
    df: DataFrame,
    key: str = "symbol",
    order: str = "date",
    tiebreak: Sequence[str] = (),
    bucket: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``_rn``: 1-based position of each row in its key's series.

    Default (``bucket=None``): rows are range-partitioned on the full
    ordering (key, order, tiebreak), so Spark's sampled range bounds cut even
    a single hot key into partitions of similar size; inside a partition the
    rows of a key are contiguous and numbered by their position
    (``monotonically_increasing_id``), and each (partition, key) adds the row
    count of the key in earlier partitions (a small per-(partition, key)
    count table with a running sum per key). The range-partitioned rows are
    checkpointed (reliable checkpoint in ``spark.checkpoint.dir``) so that the
    counts and the rows see the same partitioning.

    With ``bucket`` (a column of the order value), numbering runs per
    (key, bucket) with running offsets per key instead; cheaper, but a bucket
    holding many rows is numbered in one task.
    """
    if bucket is not None:
        return _row_number_by_bucket(df, key, order, tiebreak, bucket)
    spark = df.sparkSession
    checkpoint_root(spark)  # make sure a reliable checkpoint directory is set
    ordering = [F.col(c).asc_nulls_first() for c in (key, order, *tiebreak)]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *ordering)
        .sortWithinPartitions(*ordering)
        .withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy("_pid", key).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first")
    )
    earlier = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_pid").alias("_opid"),
        F.col(key).alias("_okey"),
        "_first",
        F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_off"),
    )
    joined = ranged.join(
        offsets,
        (ranged["_pid"] == offsets["_opid"]) & ranged[key].eqNullSafe(offsets["_okey"]),
        "inner",
    )
    return joined.withColumn("_rn", F.col("_off") + F.col("_mid") - F.col("_first") + 1).drop(
        "_pid", "_mid", "_opid", "_okey", "_first", "_off"
    )


def _row_number_by_bucket(
    df: DataFrame, key: str, order: str, tiebreak: Sequence[str], bucket: Column
) -> DataFrame:
    data = df.withColumn("_bkt", bucket)
    counts = data.groupBy(key, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(key).orderBy(F.col("_bkt").asc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        F.col(key).alias("_okey"),
        F.col("_bkt").alias("_obkt"),
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
    )
    joined = data.join(
        offsets,
        data[key].eqNullSafe(offsets["_okey"]) & data["_bkt"].eqNullSafe(offsets["_obkt"]),
        "inner",
    ).drop("_okey", "_obkt")
    within = Window.partitionBy(key, "_bkt").orderBy(
        F.col(order).asc(), *[F.col(c).asc() for c in tiebreak]
    )
    return joined.withColumn("_rn", F.col("_off") + F.row_number().over(within)).drop(
        "_off", "_bkt"
    )


def blocks_with_halo(numbered: DataFrame, longest: int, block_rows: int) -> DataFrame:
    """``numbered`` (with ``_rn``) and its block ``_blk``; the last ``longest - 1``
    rows of a block also go to the next one, there with ``_shift`` = 1."""
    if block_rows < longest - 1 or block_rows < 1:
        raise ValueError(f"block_rows must be >= {max(longest - 1, 1)}")
    pos = (F.col("_rn") - 1) % block_rows
    shifts = F.when(
        F.lit(longest > 1) & (pos >= block_rows - (longest - 1)), F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    return numbered.select(
        "*", F.explode(shifts).alias("_shift")
    ).withColumn("_blk", F.floor((F.col("_rn") - 1) / block_rows) + F.col("_shift"))


def segmented_trailing_avg(
    df: DataFrame,
    specs: Mapping[str, tuple[str, int]],
    key: str = "symbol",
    order: str = "date",
    tiebreak: Sequence[str] = (),
    block_rows: int = DEFAULT_BLOCK_ROWS,
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``out = avg(value) over the n-row trailing frame`` for each
    ``out -> (value, n)`` in ``specs``; equal to the direct window."""
    longest = max(n for _, n in specs.values())
    numbered = series_row_number(df, key, order, tiebreak, bucket)
    out = blocks_with_halo(numbered, longest, block_rows)
    for name, (value, n) in specs.items():
        w = Window.partitionBy(key, "_blk").orderBy("_rn").rowsBetween(1 - n, 0)
        out = out.withColumn(name, F.avg(value).over(w))
    return out.filter(F.col("_shift") == 0).drop("_shift", "_blk", "_rn")
