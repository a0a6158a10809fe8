"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ohlcflow.plans.storage import scratch_path

#: Words of all contracts: runs of anything but space and \x09-\x0D.
WORD_RE = r"[^\x20\x09-\x0D]+"
#: Text handled at once inside a task, in characters (bounds memory, not work).
CHUNK_CHARS = 1 << 21
#: Bytes of rows that a Python worker gets at once, and the setting that says so.
BATCH_BYTES, BATCH_SETTING = 1 << 21, "spark.sql.execution.arrow.maxBytesPerBatch"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor re-reads files, it does not recompute.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``materialize`` that nothing will read again."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def words(text: str) -> list[str]:
    """The words of ``text``; splits on space and \\x09-\\x0D only, not on other Unicode spaces."""
    for c in "\t\n\x0b\x0c\r":
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with batches of about ``BATCH_BYTES``, not 10,000 whole texts.

    The executor and its Python worker both hold a batch whole, and both keep the
    space. Spark reads the setting when the result is, so it stays in the session;
    one that the session has already is left as it is.
    """
    conf = df.sparkSession.conf
    if BATCH_SETTING not in conf.getAll:
        conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    return df.mapInArrow(function, schema)


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[list[list], list[str]]]:
    """Rows of the batches in runs of about ``CHUNK_CHARS`` of text.

    Yields (other columns as lists, texts); a null text is empty. Text stays
    in Arrow until its run is due.
    """
    for batch in batches:
        at = batch.schema.get_field_index(text)
        column = batch.column(at)
        lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = 0
        while start < batch.num_rows:
            end, size = start, 0
            while end < batch.num_rows and (end == start or size + lengths[end] <= CHUNK_CHARS):
                size += lengths[end]
                end += 1
            part = batch.slice(start, end - start)
            others = [part.column(i).to_pylist() for i in range(part.num_columns) if i != at]
            yield others, [t or "" for t in part.column(at).to_pylist()]
            start = end


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ranged(df: DataFrame, order: list, rows_each: int, name: str) -> DataFrame:
    """``df`` materialized in range partitions of about ``rows_each`` rows, with the partition's number as ``_part``.

    The number rises with ``order``. Let ``order`` end with a column that tells
    all rows apart: then equal keys are cut as well.
    """
    parts = max(1, -(-df.count() // rows_each))
    return materialize(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)


#: Characters of a text that put rows of one id in order; where they are equal, a hash of the whole text does.
ORDER_CHARS = 64


def document_order(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """(doc_id, text) of ``docs`` with the columns that put all rows in one order: by id, text and, for equal rows, row number.

    The keys are short, so that range bounds can be sampled; they tell all rows
    apart, so that no id and no repeated text is more than range partitions can cut.
    """
    keys = {"_head": F.substring("text", 1, ORDER_CHARS), "_h": F.xxhash64("text"), "_row": F.monotonically_increasing_id()}
    return docs.select("doc_id", "text").withColumns(keys), ["doc_id", *keys]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def prefix_sums(df: DataFrame, keys: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """Running sum of ``value`` per ``keys`` over (``bucket``, ``order``), the row included.

    No key is summed in one task: rows are windowed per (keys, bucket), and
    the sums of whole buckets, one row each, give every bucket its base.
    """
    from pyspark.sql import Window

    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(bucket).alias("_b"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"),
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col(bucket) == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (
        df.withColumn("_inside", F.sum(value).over(inside))
        .join(bases, same)
        .withColumn(out, F.col("_inside") + F.col("_base"))
        .drop("_inside", "_b", "_base", *[f"_k{i}" for i in range(len(keys))])
    )


def connected_components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for the nodes of ``edges(a, b)``; component is the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes: the
    number of rounds grows with the logarithm of the longest path. Each
    round's links are written, so no lineage builds up, and none reaches the
    driver but a count.
    """
    links = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    for _ in range(rounds):
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(low.select("u", F.col("m").alias("v")))
        new = materialize(small.distinct(), "links")
        if new.exceptAll(links).isEmpty() and links.exceptAll(new).isEmpty():
            discard(links)
            links = new
            break
        discard(links)
        links = new
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    own = links.groupBy("u").agg(F.min("v").alias("component"))
    roots = links.select("v").distinct().join(own, F.col("v") == F.col("u"), "left_anti")
    return own.select(F.col("u").alias("node"), "component").unionAll(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )


def span_digest(spans: Column, kinds: list[str], by_start: bool) -> Column:
    """``kind:start:end`` of spans (struct<kind: index, start, end>), comma-joined, by start and kind or by kind and start."""
    names = F.array(*map(F.lit, kinds))
    key = ["start", "kind", "end"] if by_start else ["kind", "start", "end"]
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(*[s[k].alias(k) for k in key])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def labelled_sample(labels: DataFrame, label: str, per_class: dict[int, int]) -> DataFrame:
    """(doc_id, label): of each class the rows with the least hashes, at most ``per_class`` of them."""
    parts = [
        labels.where(F.col(label) == c).select("doc_id", F.col(label).alias("label")).where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for c, n in per_class.items()
    ]
    from functools import reduce

    return reduce(DataFrame.unionAll, parts)


def of_kind(spans: str, kind: int) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
