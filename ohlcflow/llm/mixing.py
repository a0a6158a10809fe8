"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, once through and
then, for what its target still lacks, again (``max_epochs`` passes at most).
A copy's virtual finish time is the tokens of its source up to and including
it, divided by the source's target. Copies are put in order of finish time
over all sources and taken until the total budget is spent, so each source
has received its share at every point of the order.

Targets share the budget by weight; one that would pass ``max_epochs`` times
its source stops there and the excess goes to the others by weight. All sums
run over range partitions of the whole order (``prefix_sums``), first of the
shuffled queues, then of the finish times. The order ends with a row number,
so the partitions have about the same size whatever a third of all rows has in
common: its source, its id and text, or a finish time of 0. ``mix`` shuffles no
texts; ``take`` joins its result with the documents.

Defined cases: a null or empty text has size 0 and is taken 0 times over; a
null source is a source of its own, last; rows with equal ids are separate
documents, in the order of their sizes, texts' hashes and places in the table;
other columns stay as they are, whatever their names; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ohlcflow.llm.common import WORD_RE, discard, free_name, materialize, prefix_sums, ranged

#: Rows of a range partition of an order.
BUCKET_ROWS = 20_000


def n_words(text: str | Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, max_epochs: int = 2) -> DataFrame:
    """(source, source_size, target) from one row per source; weights repeat over the sources by code point, null last."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    by_cap = Window.orderBy("_r", F.col("source").asc_nulls_last())
    return (
        sizes.withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("_r", F.col("_cap") / F.col("_w"))
        .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(percent / 100))
        .withColumn("_full", F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_open", F.sum("_w").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        # were the sources before this one full, the others would get this much for each unit of weight
        .withColumn("_level", (F.col("_budget") - F.col("_full")) / F.col("_open"))
        .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_r"), F.col("_level"))).over(everything))
        .select("source", "source_size", F.coalesce(F.least("_cap", F.col("_level") * F.col("_w")), F.col("_cap")).alias("target"))
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, max_epochs: int = 2, seed: str = "mix", row: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: what the mix takes of every row of ``docs``.

    ``row`` names a column that is unique to each row and is then returned as
    well; without it rows are told apart by a number given here.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = materialize(
        docs.select(
            "doc_id",
            "source",
            n_words("text").alias("size"),
            F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long").alias("_h"),
            F.xxhash64("text").alias("_t"),
            (F.col(row) if row else F.monotonically_increasing_id()).alias("_row"),
        ),
        "mix-sizes",
    )
    order = ["_h", "doc_id", "size", "_t", "_row"]
    last = F.col("source").asc_nulls_last()
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, percent, max_epochs)
    dealt = ranged(rows, [last, *order], BUCKET_ROWS, "mix-order")
    queue = prefix_sums(dealt, ["source"], "_part", order, "size", "_end").drop("_part")
    goals = goals.select(F.col("source").alias("_s"), "source_size", "target")
    queue = materialize(queue.join(goals, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "mix-queue")
    discard(dealt)
    total = queue.select(F.coalesce(F.sum("size") * F.lit(percent / 100), F.lit(0.0))).first()[0]
    copies = (
        queue.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
        .withColumn("_finish", F.coalesce(F.try_divide(F.col("_end") + F.col("_epoch") * F.col("source_size"), F.col("target")), F.lit(0.0)))
        .withColumn("_all", F.lit(0))
    )
    finish = ["_finish", last, *order, "_epoch"]
    spent = prefix_sums(ranged(copies, finish, BUCKET_ROWS, "mix-finish"), ["_all"], "_part", finish, "size", "_spent")
    taken = F.when((F.col("_spent") <= total) & (F.col("size") > 0), 1).otherwise(0)
    return (
        spent.groupBy("_row", "doc_id", "size", "source_size", "target")
        .agg(F.sum(taken).cast("int").alias("copies"))
        .select(*([F.col("_row").alias(row)] if row else []), "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
    )


def take(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as mixed: every row as often as the mix takes it, columns unchanged."""
    row, times, copy = (free_name(docs, n) for n in ("_row_of_mix", "_times_of_mix", "_copy_of_mix"))
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    copies = mix(numbered, row=row, **options).where("copies > 0").select(row, F.col("copies").alias(times))
    repeats = F.explode(F.array_repeat(F.lit(0), F.col(times)))
    return numbered.join(copies, row).select(*[F.col(f"`{c}`") for c in docs.columns], repeats.alias(copy)).drop(copy)
