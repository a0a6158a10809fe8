import pytest

from ohlcflow.operators.quality import (
    CHECK_NAMES,
    GATE_CHECKS,
    QualityGateError,
    assert_quality,
    dq_duplicates,
    dq_low_rows,
    dq_report,
    missing_symbols,
    quality_counts,
)
from ohlcflow.operators.clean import cast_schema
from ohlcflow.plans.silver import to_silver


def _report(df, expected, min_rows=100):
    return {r["check_name"]: (r["fail_count"], r["status"]) for r in dq_report(df, expected, min_rows).collect()}


def test_dirty_sample_report(dirty_sample):
    typed = cast_schema(dirty_sample)
    rep = _report(typed, ["OSTB", "WEST"], min_rows=2)
    assert list(rep) == CHECK_NAMES
    assert rep["null_symbols"] == (1, "FAILED")
    assert rep["null_dates"] == (0, "PASSED")
    assert rep["negative_prices"] == (1, "FAILED")
    assert rep["high_lt_low"] == (1, "FAILED")
    assert rep["duplicates"] == (1, "FAILED")
    assert rep["missing_symbols"] == (1, "FAILED")
    # groups below 2 rows: the NULL-symbol group (1 row); OSTB has 4
    assert rep["low_row_count"] == (1, "FAILED")


def test_missing_symbol_with_null_present(raw_bars):
    silver = to_silver(raw_bars([
        ("A", "2021-01-04", "1", "2", "1", "1", "1"),
        (None, "2021-01-04", "1", "2", "1", "1", "1"),
    ]), audit=False)
    assert [r["expected_symbol"] for r in missing_symbols(silver, ["A", "Z"]).collect()] == ["Z"]
    assert missing_symbols(silver, ["A", "Z"], null_aware=True).count() == 0
    assert _report(silver, ["A", "Z", "Z"])["missing_symbols"] == (2, "FAILED")
    assert _report(silver, [])["missing_symbols"] == (0, "PASSED")


def test_duplicates_and_low_rows(raw_bars):
    typed = cast_schema(raw_bars([
        ("A", "2021-01-04", "1", "2", "1", "1", "1"),
        ("A", "2021-01-04", "1", "2", "1", "1", "1"),
        ("A", "2021-01-04", "1", "2", "1", "1", "1"),
        ("B", "2021-01-05", "1", "2", "1", "1", "1"),
    ]))
    d = dq_duplicates(typed).collect()
    assert [(r["symbol"], r["cnt"]) for r in d] == [("A", 3)]
    assert sorted((r["symbol"], r["cnt"]) for r in dq_low_rows(typed, 2).collect()) == [("B", 1)]


def test_empty_input(spark):
    from ohlcflow.schemas import TYPED_BAR_SCHEMA
    empty = spark.createDataFrame([], TYPED_BAR_SCHEMA)
    rep = _report(empty, ["A"])
    assert rep["missing_symbols"] == (1, "FAILED")
    assert all(v == (0, "PASSED") for k, v in rep.items() if k != "missing_symbols")


def test_gate(dirty_sample, sample_bars):
    rep = dq_report(cast_schema(dirty_sample), ["OSTB"])
    with pytest.raises(QualityGateError) as e:
        assert_quality(rep, GATE_CHECKS)
    assert e.value.failed == ["null_symbols", "negative_prices", "duplicates"]
    ok = assert_quality(dq_report(to_silver(sample_bars, audit=False), ["NORD"], 4), ["null_symbols", "duplicates"])
    assert ok["null_symbols"] == 0
    with pytest.raises(KeyError):
        assert_quality(rep, ["nope"])


def test_long_expected_list_uses_a_table(spark, raw_bars, monkeypatch):
    import ohlcflow.operators.quality as Qm

    silver = to_silver(raw_bars([
        ("A", "2021-01-04", "1", "2", "1", "1", "1"),
        ("B", "2021-01-04", "1", "2", "1", "1", "1"),
    ]), audit=False)
    expected = ["A", "B", "Z", "Z", None] + [f"X{i}" for i in range(10)]
    inline = _report(silver, expected)["missing_symbols"]
    monkeypatch.setattr(Qm, "INLINE_EXPECTED_LIMIT", 2)
    joined = _report(silver, expected)["missing_symbols"]
    assert inline == joined == (13, "FAILED")


def test_missing_symbols_long_list(spark, raw_bars, monkeypatch):
    import ohlcflow.operators.quality as Qm

    silver = to_silver(raw_bars([("A", "2021-01-04", "1", "2", "1", "1", "1")]), audit=False)
    expected = ["A", "Z", None] + [f"X{i}" for i in range(5)]
    short = sorted(str(r[0]) for r in missing_symbols(silver, expected).collect())
    monkeypatch.setattr(Qm, "INLINE_EXPECTED_LIMIT", 1)
    long = sorted(str(r[0]) for r in missing_symbols(silver, expected).collect())
    assert short == long == sorted(["Z", "None"] + [f"X{i}" for i in range(5)])


def test_report_holds_no_map_of_keys(spark):
    """Deduplicated rows are met in key order: neither hashed per (symbol, date) nor sorted again."""
    from ohlcflow.operators.clean import deduplicate

    rows = spark.range(40).selectExpr(
        "if(id % 9 = 0, null, concat('S', id % 4)) symbol", "if(id % 7 = 0, null, date_add(date'2020-01-01', int(id % 5))) date",
        "double(id - 2) open", "double(id) high", "double(id % 3 * id) low", "double(id) close", "id volume",
    )
    for df in (rows, deduplicate(rows, ["symbol", "date"])):
        counts = quality_counts(df, by_sort=True)
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" not in plan and plan.count("SortAggregate(") == 2
        assert sorted(map(repr, counts.collect())) == sorted(map(repr, quality_counts(df).collect()))
    assert plan.count("Sort [") == 2  # those of the deduplication, before and after its shuffle
    assert "HashAggregate(keys=[symbol" in dq_report(rows)._jdf.queryExecution().executedPlan().toString()  # per symbol
    assert "SortAggregate(key=[symbol" in dq_report(rows)._jdf.queryExecution().executedPlan().toString()  # per key
