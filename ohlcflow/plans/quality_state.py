"""Quality counts kept per batch, so that the gate does not read its rows again.

Every batch leaves its counts per (symbol, date) in a state table, partitioned
by ``(_stream, _batch_number)``: one narrow row a key instead of the bars. The
counts are additive, so the report over everything ingested so far comes from
summing the state. A batch that is replayed replaces its own counts, and a
compaction merges the counts of many batches into one row a key; batches that it
holds are remembered, so that a replay of one of them changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import quality_counts, report_of_counts
from ..schemas import DQ_FAILED, DQ_PASSED, MIN_ROWS_PER_SYMBOL
from .storage import path_exists, remove_path

_COUNTS = "symbol string, date date, n long, neg long, hl long"
_BATCHED = f"{_COUNTS}, _stream string, _batch_number int"
_HELD = "stream string, batch int"


class QualityState:
    """The state table under ``root``: ``batches`` and, compacted, ``merged-<k>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> int:
        """Number of the last complete compaction (0: none); its list of held batches is written last."""
        k = 0
        while path_exists(self.spark, f"{self.root}/held-{k + 1}/_SUCCESS"):
            k += 1
        return k

    def _batches(self) -> DataFrame:
        """Counts of the batches that no compaction holds."""
        path = f"{self.root}/batches"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], _BATCHED)
        rows = self.spark.read.schema(_BATCHED).parquet(path)
        held = self._held()
        same = [F.col("_stream").eqNullSafe(F.col("stream")), F.col("_batch_number").eqNullSafe(F.col("batch"))]
        return rows.join(held, same, "left_anti")

    def _held(self) -> DataFrame:
        k = self._versions()
        return self.spark.read.schema(_HELD).parquet(f"{self.root}/held-{k}") if k else self.spark.createDataFrame([], _HELD)

    def add(self, rows: DataFrame) -> None:
        """Note the counts of typed rows with ``_stream`` and ``_batch_number``; a batch's earlier counts are replaced.

        A batch must come whole: all its rows in one call.
        """
        counts = quality_counts(rows, more_keys=("_stream", "_batch_number"))
        counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_stream", "_batch_number").parquet(f"{self.root}/batches")

    def counts(self) -> DataFrame:
        """(symbol, date, n, neg, hl) over everything added."""
        names = ["symbol", "date", "n", "neg", "hl"]
        rows = self._batches().select(*names)
        if k := self._versions():
            rows = rows.unionByName(self.spark.read.schema(_COUNTS).parquet(f"{self.root}/merged-{k}"))
        return rows.groupBy("symbol", "date").agg(*[F.sum(c).alias(c) for c in names[2:]])

    def report(
        self,
        expected_symbols: Sequence[str | None] | None = None,
        min_rows: int = MIN_ROWS_PER_SYMBOL,
        passed: str = DQ_PASSED,
        failed: str = DQ_FAILED,
    ) -> DataFrame:
        """The seven checks over everything added."""
        return report_of_counts(self.counts(), expected_symbols, min_rows, passed, failed)

    def compact(self) -> None:
        """Merge the counts of all batches into one row a key and forget the version before."""
        k = self._versions() + 1
        batches = self._batches().select(F.col("_stream").alias("stream"), F.col("_batch_number").alias("batch")).distinct()
        held = self._held().unionByName(batches)
        self.counts().write.mode("overwrite").parquet(f"{self.root}/merged-{k}")
        held.write.mode("overwrite").parquet(f"{self.root}/held-{k}")
        if k > 2:  # readers of the version before may still run
            remove_path(self.spark, f"{self.root}/merged-{k - 2}")
