from pyspark.sql import functions as F

from ohlcflow.operators.clean import cast_schema
from ohlcflow.operators.features import add_moving_averages, add_volume_spike_flag
from ohlcflow.operators.marts import stock_summary, top_movers, volume_analysis
from ohlcflow.operators.signals import crossover, crossover_join, latest_signal, top_gains, top_volume_spikes
from ohlcflow.operators.views import vw_stock_summary, vw_top_movers, vw_volume_spikes
from ohlcflow.plans.silver import to_silver


def _silver(raw_bars, rows):
    return to_silver(raw_bars(rows), audit=False)


def _by_date(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("symbol", "date").collect()]


def test_hand_rows(raw_bars):
    rows = [
        ("X1", "2021-03-01", "50", "52", "49", "51", "100"),
        ("X1", "2021-03-02", "50", "50", "50", "50", "0"),
        ("X1", "2021-03-03", "100", "160", "100", "150", "10"),
        ("X1", "2021-03-04", "100", "160", "100", "151", "10"),
    ]
    s = _silver(raw_bars, rows)
    got = _by_date(s, "daily_return_pct", "price_range", "price_spike_flag")
    assert got == [(2.0, 3.0, False), (0.0, 0.0, False), (50.0, 60.0, False), (51.0, 60.0, True)]
    labels = _by_date(vw_stock_summary(stock_summary(s)), "performance_label")
    assert [x[0] for x in labels] == ["GAIN", "FLAT", "STRONG GAIN", "STRONG GAIN"]
    movers = top_movers(s).orderBy("date").collect()
    assert [(r["date"].day, r["direction"]) for r in movers] == [(1, "GAINER"), (2, "LOSER"), (3, "GAINER")]


def test_label_edges(raw_bars):
    rows = [("L", f"2021-04-0{i + 1}", "100", "110", "90", c, "1") for i, c in enumerate(["103", "101", "99", "97", "100.5"])]
    got = _by_date(vw_stock_summary(stock_summary(_silver(raw_bars, rows))), "performance_label")
    assert [x[0] for x in got] == ["STRONG GAIN", "GAIN", "LOSS", "STRONG LOSS", "FLAT"]


def test_ma_warm_up_and_per_symbol(raw_bars):
    rows = [("A", f"2021-01-0{i}", "1", "9", "0.5", str(i), "1") for i in range(1, 5)]
    rows += [("B", "2021-01-01", "1", "9", "0.5", "7", "1")]
    out = add_moving_averages(cast_schema(raw_bars(rows)), [1, 3])
    assert _by_date(out, "ma_3d") == [(1.0,), (1.5,), (2.0,), (3.0,), (7.0,)]
    assert out.filter(F.col("ma_1d") != F.col("close")).count() == 0


def test_volume_spike(raw_bars):
    rows = [("V", f"2021-01-0{i + 1}", "1", "2", "1", "1", v) for i, v in enumerate(["1", "1", "1", "10"])]
    out = add_volume_spike_flag(cast_schema(raw_bars(rows)))
    assert _by_date(out, "avg_30d_volume", "volume_spike") == [
        (1.0, False), (1.0, False), (1.0, False), (3.25, True)
    ]
    va = volume_analysis(_silver(raw_bars, rows)).collect()
    assert len(va) == 1 and va[0]["volume"] == 10
    vs = vw_volume_spikes(volume_analysis(_silver(raw_bars, rows))).collect()
    assert (vs[0]["avg_30d_volume"], vs[0]["volume_ratio"]) == (3.0, 3.08)


def test_rank_ties(raw_bars):
    rows = [
        ("A", "2021-01-04", "100", "110", "90", "105", "1"),
        ("B", "2021-01-04", "100", "110", "90", "105", "1"),
        ("C", "2021-01-04", "100", "110", "90", "104", "1"),
    ]
    s = _silver(raw_bars, rows)
    assert sorted(r["rank"] for r in top_movers(s).collect()) == [1, 1, 2]
    assert top_movers(s, top_n=1).count() == 2
    assert vw_top_movers(top_movers(s), top_n=1).count() == 2


def test_crossover_forms_agree(spark, sample_bars):
    s = cast_schema(sample_bars)
    a = crossover(s, ordered=False)
    b = crossover_join(s, ordered=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    states = {r["crossover_signal"] for r in a.collect()}
    assert states <= {"GOLDEN CROSS", "DEATH CROSS", "NEUTRAL"}


def test_reports(raw_bars, sample_bars):
    summary = stock_summary(to_silver(sample_bars, audit=False))
    vw = vw_stock_summary(summary)
    latest = {r["symbol"]: r for r in latest_signal(vw).collect()}
    assert latest["NORD"]["latest_date"].day == 5 and latest["SUDW"]["latest_date"].day == 4
    g = top_gains(vw, symbol="NORD", k=2).collect()
    assert [r["daily_return_pct"] for r in g] == [5.0, 5.0]
    assert top_gains(vw, k=2).count() == 4
    assert top_volume_spikes(vw_volume_spikes(volume_analysis(to_silver(sample_bars, audit=False)))).count() == 0


def test_rank_one_exists_per_group(spark):
    from scales import SF_SMALL
    from ohlcflow import queries as Q
    m = Q.q_top_movers(spark, "/root/testdata/sf0.01")
    groups = m.select("date", "direction").distinct().count()
    assert m.filter("rank = 1").select("date", "direction").distinct().count() == groups
    assert m.filter("rank > 10").count() == 0
    s = Q.q_stock_summary(spark, SF_SMALL)
    assert s.count() == Q.clean_silver(spark, SF_SMALL).count()


def test_movers_tie_safe_plan_equals_window_plan(spark, raw_bars):
    from ohlcflow import queries as Q

    s = Q.clean_silver(spark, "/root/testdata/sf0.001")
    a, b = top_movers(s), top_movers(s, ties="join")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # one date where every symbol has the same return (one huge tie), plus NULLs
    rows = [(f"T{i:03d}", "2021-01-04", "100", "110", "90", "102", "1") for i in range(300)]
    rows += [("N1", "2021-01-04", "0", "1", "1", "1", "1"), ("U1", "2021-01-04", "100", "110", "90", "101", "1")]
    t = _silver(raw_bars, rows)
    a, b = top_movers(t, top_n=1), top_movers(t, top_n=1, ties="join")
    assert a.count() == 300
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
