"""Data-quality checks on silver and the gate that stops the pipeline.

``dq_report`` evaluates all seven checks of the reference in one scan:
(symbol, date) groups -> symbol groups -> one global row, each level a
partial/final aggregate, so no per-check rescans and no hot-key exchange
(a key's rows are combined map-side before they are shuffled).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import dq_status
from ..schemas import DQ_FAILED, DQ_PASSED, MIN_ROWS_PER_SYMBOL

# --- fixed values: check names and their order -----------------------------
CHECK_NAMES = [
    "null_symbols",
    "null_dates",
    "negative_prices",
    "high_lt_low",
    "duplicates",
    "missing_symbols",
    "low_row_count",
]
# The three checks of the orchestration gate.
GATE_CHECKS = ["null_symbols", "negative_prices", "duplicates"]
# The six checks of the SQL-layer runner (no missing_symbols).
RUNNER_CHECKS = [c for c in CHECK_NAMES if c != "missing_symbols"]
# ---------------------------------------------------------------------------


class QualityGateError(Exception):
    """Raised by :func:`assert_quality` when a selected check fails."""

    def __init__(self, failed: Sequence[str], counts: dict[str, int]):
        self.failed = list(failed)
        self.counts = dict(counts)
        detail = ", ".join(f"{n}={counts[n]}" for n in self.failed)
        super().__init__(f"DQ checks failed: {detail}")


def non_positive_price(columns: Sequence[str] = ("open", "high", "low", "close")) -> Column:
    """Any of ``columns`` <= 0 (SQL three-valued: a NULL alone does not count).

    The orchestration gate's variant tests ``("open", "close")`` only.
    """
    cond = None
    for c in columns:
        cond = (F.col(c) <= 0) if cond is None else (cond | (F.col(c) <= 0))
    return cond


# Up to this many distinct expected symbols are inlined as a literal map;
# longer lists are joined as a (broadcast, list-sized) table instead.
INLINE_EXPECTED_LIMIT = 256


def _expected_weights(expected: Sequence[str | None]) -> dict[str, int]:
    """How many entries of ``expected`` each non-NULL symbol satisfies."""
    weights: dict[str, int] = {}
    for s in expected:
        if s is not None:
            weights[s] = weights.get(s, 0) + 1
    return weights


def _with_expected_weight(per_symbol: DataFrame, expected: Sequence[str | None]) -> DataFrame:
    """Add ``_w``: the number of expected entries a symbol row satisfies."""
    weights = _expected_weights(expected)
    if not weights:
        return per_symbol.withColumn("_w", F.lit(0))
    if len(weights) <= INLINE_EXPECTED_LIMIT:
        m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(v))])
        return per_symbol.withColumn("_w", F.coalesce(F.try_element_at(m, F.col("symbol")), F.lit(0)))
    spark = per_symbol.sparkSession
    table = spark.createDataFrame(list(weights.items()), "_sym string, _cnt int")
    joined = per_symbol.join(F.broadcast(table), per_symbol["symbol"] == table["_sym"], "left")
    return joined.withColumn("_w", F.coalesce(F.col("_cnt"), F.lit(0))).drop("_sym", "_cnt")


def dq_report(
    silver: DataFrame,
    expected_symbols: Sequence[str | None] | None = None,
    min_rows: int = MIN_ROWS_PER_SYMBOL,
    passed: str = DQ_PASSED,
    failed: str = DQ_FAILED,
    price_columns: Sequence[str] = ("open", "high", "low", "close"),
) -> DataFrame:
    """Seven rows ``(check_name, fail_count, status)``.

    * null_symbols / null_dates: rows with a NULL symbol / date;
    * negative_prices: rows with any of ``price_columns`` <= 0;
      high_lt_low: rows with high < low;
    * duplicates: (symbol, date) groups with more than one row (NULLs group);
    * missing_symbols: entries of ``expected_symbols`` with no row in silver,
      NOT EXISTS semantics (a NULL symbol in silver matches nothing and hides
      nothing);
    * low_row_count: symbol groups (NULL symbol included) with < ``min_rows`` rows.

    ``passed`` / ``failed`` name the status words (the SQL file uses
    PASSED/FAILED, the runner PASS/FAIL).
    """
    counts = quality_counts(silver, price_columns, by_sort=True)
    return report_of_counts(counts, expected_symbols, min_rows, passed, failed)


def quality_counts(
    df: DataFrame,
    price_columns: Sequence[str] = ("open", "high", "low", "close"),
    more_keys: Sequence[str] = (),
    by_sort: bool = False,
) -> DataFrame:
    """(symbol, date, n, neg, hl): what the checks need of the rows of each key (and ``more_keys``).

    The counts of several tables add up to those of their union, so they can be
    kept per batch (:mod:`ohlcflow.plans.quality_state`).

    ``by_sort``: the keys are met in order, one at a time, instead of being held in
    hash maps (most keys have one row, so a map holds about as much as the rows).
    Rows that come from :func:`~ohlcflow.operators.clean.deduplicate` are in that
    order already; others are sorted, which spills.
    """
    counts = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(non_positive_price(price_columns)).alias("neg"),
        F.count_if(F.col("high") < F.col("low")).alias("hl"),
    ]
    grouped = df.groupBy("symbol", "date", *more_keys)
    if not by_sort:
        return grouped.agg(*counts)
    # Spark aggregates by sort where a text is among the values: here the key's own
    return grouped.agg(F.max("symbol").alias("_name"), *counts).select(
        F.col("_name").alias("symbol"), "date", *more_keys, "n", "neg", "hl"
    )


def report_of_counts(
    per_key: DataFrame,
    expected_symbols: Sequence[str | None] | None = None,
    min_rows: int = MIN_ROWS_PER_SYMBOL,
    passed: str = DQ_PASSED,
    failed: str = DQ_FAILED,
) -> DataFrame:
    """The report of :func:`dq_report` from one row of counts per (symbol, date)."""
    expected = list(expected_symbols or [])
    per_symbol = per_key.groupBy("symbol").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("date").isNull(), F.col("n"))).alias("null_date_rows"),
        F.sum("neg").alias("neg"),
        F.sum("hl").alias("hl"),
        F.count_if(F.col("n") > 1).alias("dup_groups"),
    )
    total = _with_expected_weight(per_symbol, expected).agg(
        F.sum(F.when(F.col("symbol").isNull(), F.col("rows"))).alias("null_symbols"),
        F.sum("null_date_rows").alias("null_dates"),
        F.sum("neg").alias("negative_prices"),
        F.sum("hl").alias("high_lt_low"),
        F.sum("dup_groups").alias("duplicates"),
        (F.lit(len(expected)) - F.coalesce(F.sum("_w"), F.lit(0))).alias("missing_symbols"),
        F.count_if(F.col("rows") < min_rows).alias("low_row_count"),
    )
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("check_name"),
                    F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long")).alias("fail_count"),
                )
                for name in CHECK_NAMES
            ]
        )
    )
    return total.select(rows).withColumn("status", dq_status("fail_count", passed, failed))


def dq_duplicates(df: DataFrame, key_cols: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Key groups with more than one row, with their size ``cnt``."""
    return df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def dq_low_rows(df: DataFrame, min_rows: int = MIN_ROWS_PER_SYMBOL) -> DataFrame:
    """Symbol groups (NULL symbol included) with fewer than ``min_rows`` rows."""
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") < min_rows)


def missing_symbols(
    df: DataFrame, expected_symbols: Iterable[str | None], null_aware: bool = False
) -> DataFrame:
    """Expected symbols absent from ``df`` (column ``expected_symbol``).

    Default: NOT EXISTS semantics (left anti join). ``null_aware=True``
    reproduces ``NOT IN (SELECT symbol ...)``: a single NULL symbol in ``df``
    makes the result empty, and NULL expected entries never appear.

    Size bound: the right side is first restricted to the expected symbols,
    so it has at most ``len(expected_symbols)`` rows and is broadcast; the
    large table is only scanned (with the IN filter pushed to the source).
    """
    spark = df.sparkSession
    expected = list(expected_symbols)
    exp_df = spark.createDataFrame([(s,) for s in expected], "expected_symbol string")
    wanted = [s for s in dict.fromkeys(expected) if s is not None]
    symbols = df.select("symbol")
    if len(wanted) <= INLINE_EXPECTED_LIMIT:
        present = symbols.filter(F.col("symbol").isin(wanted))
    else:  # long lists: semi join against the (broadcast, list-sized) expected table
        keys = spark.createDataFrame([(s,) for s in wanted], "_sym string")
        present = symbols.join(F.broadcast(keys), symbols["symbol"] == keys["_sym"], "left_semi")
    present = present.distinct()
    out = exp_df.join(
        F.broadcast(present), exp_df["expected_symbol"] == present["symbol"], "left_anti"
    )
    if null_aware:
        # uncorrelated NOT EXISTS: a one-row scalar subquery, no join
        any_null = df.filter(F.col("symbol").isNull()).exists()
        out = out.filter(F.col("expected_symbol").isNotNull() & ~any_null)
    return out


def assert_quality(report: DataFrame, checks: Sequence[str] | None = None) -> dict[str, int]:
    """Raise :class:`QualityGateError` if any selected check has failures.

    ``report`` is the seven-row output of :func:`dq_report` (collecting it
    moves seven rows). ``checks`` selects a subset, e.g. the three checks
    of the orchestration gate; default: all. Returns the counts.
    """
    counts = {r["check_name"]: int(r["fail_count"]) for r in report.collect()}
    names = list(checks) if checks is not None else list(counts)
    unknown = [n for n in names if n not in counts]
    if unknown:
        raise KeyError(f"unknown checks: {unknown}")
    failed = [n for n in names if counts[n] > 0]
    if failed:
        raise QualityGateError(failed, counts)
    return counts
