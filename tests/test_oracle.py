"""Every registered query against its DuckDB oracle, plus fixture counts."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare  # noqa: E402

from scales import SF_SMALL  # noqa: E402
from ohlcflow import queries as Q  # noqa: E402


def test_every_key_has_an_oracle():
    assert set(Q.ORACLE_SQL) == set(Q.QUERIES)


def test_all_queries_match_oracle_sf0001(spark):
    res = compare(spark, SF_SMALL, list(Q.QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v["status"] != "match"}
    assert not bad, bad


def test_fixture_counts_sf0001(spark):
    assert Q.clean_bars(spark, SF_SMALL).count() == 5334
    assert Q.raw_dirty_bars(spark, SF_SMALL).count() == 5406
    assert Q.dirty_silver(spark, SF_SMALL).count() == 5071
    rep = {r["check_name"]: r["fail_count"] for r in Q.q_dq_report(spark, SF_SMALL).collect()}
    assert rep == {
        "null_symbols": 47, "null_dates": 10, "negative_prices": 0, "high_lt_low": 0,
        "duplicates": 0, "missing_symbols": 1, "low_row_count": 1,
    }
    s = Q.clean_silver(spark, SF_SMALL)
    assert s.filter("price_spike_flag").count() == 1
    assert Q.q_volume_analysis(spark, SF_SMALL).count() == 256
    assert Q.q_top_movers(spark, SF_SMALL).count() == 5333


@pytest.mark.parametrize("ansi", ["false"])
def test_ansi_off_same_result(spark, ansi):
    keys = ["cast_schema", "silver", "dq_report", "vw_volume_spikes"]
    on = {k: sorted(map(tuple, Q.QUERIES[k](spark, SF_SMALL).collect()), key=repr) for k in keys}
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for k in keys:
            off = sorted(map(tuple, Q.QUERIES[k](spark, SF_SMALL).collect()), key=repr)
            assert off == on[k], k
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
