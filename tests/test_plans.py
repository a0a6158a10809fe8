"""Physical-plan shape: the properties the scale design relies on."""

from scales import SF_SMALL
from ohlcflow import queries as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df.collect()
    return _plan(df)


def test_three_moving_averages_one_window_one_exchange(spark):
    p = _plan(Q.q_moving_average(spark, SF_SMALL))
    # one shuffle makes the bars from ticks, one serves all windows
    assert p.count("+- Window [") == 1
    assert p.count("Exchange ") == 2


def test_ordered_series_single_exchange(spark):
    p = _plan(Q.q_crossover(spark, SF_SMALL))
    assert p.count("Exchange ") == 2 and "rangepartitioning(symbol" in p


def test_top_movers_prunes_before_shuffle(spark):
    p = _plan(Q.q_top_movers(spark, SF_SMALL))
    assert p.count("WindowGroupLimit") == 2


def test_dedup_prunes_before_shuffle(spark):
    p = _plan(Q.q_dedup(spark, SF_SMALL))
    assert p.count("WindowGroupLimit") == 2


def test_dq_report_single_scan(spark):
    p = _plan(Q.q_dq_report(spark, SF_SMALL))
    assert p.count("FileScan parquet") == 1
    # dedup's (symbol, date) exchange is reused by the per-key level; then
    # one exchange for the per-symbol level and the single-row final merge
    # (and the one that makes the bars)
    assert p.count("Exchange hashpartitioning") == 3
    assert p.count("Exchange SinglePartition") == 1


def test_missing_symbols_broadcasts_bounded_side(spark):
    p = _plan(Q.q_missing_symbols(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p


def test_parquet_scan_prunes_columns(spark):
    p = _plan(Q.q_stock_summary(spark, SF_SMALL))
    assert "l_returnflag" not in p and "l_discount" not in p


FORBIDDEN = (
    "CartesianProduct",          # cross joins
    "BroadcastNestedLoopJoin",   # non-equi joins
    "BatchEvalPython",           # row-at-a-time Python UDFs
    "ArrowEvalPython",           # pandas UDFs (none needed here)
    "FlatMapGroupsInPandas",
    "MapInPandas",
)


# Keys whose result is a scan of tables that they wrote: there is no plan of theirs to look at.
WRITTEN = {"streaming_silver", "incremental_silver", "incremental_stock_summary", "incremental_marts"}


def test_no_cross_joins_or_python_in_any_registered_query(spark):
    for name, fn in Q.QUERIES.items():
        if name in WRITTEN:
            continue
        plan = _plan(fn(spark, SF_SMALL))
        bad = [op for op in FORBIDDEN if op in plan]
        assert not bad, (name, bad)
