"""Column expressions on edge values."""

from pyspark.sql import functions as F

from ohlcflow.functions import (
    crossover_signal,
    daily_return,
    direction,
    is_finite,
    ma30_signal,
    performance_label,
    price_range,
    price_spike,
)


def test_edge_values(spark):
    inf = float("inf")
    rows = [
        (0.0, 1.0, 2.0, 1.0),      # open 0 -> return NULL
        (100.0, 100.0, 3.0, 1.0),  # flat
        (None, 1.0, None, 1.0),    # NULLs
        (inf, 1.0, inf, 1.0),      # infinite
        (100.0, 100.00005, 1.0, 1.0),  # rounds half up at the 4th decimal
    ]
    df = spark.createDataFrame(rows, "open double, close double, high double, low double")
    out = df.select(
        daily_return("open", "close").alias("r"),
        price_range("high", "low").alias("pr"),
        is_finite("open").alias("fin"),
    ).collect()
    assert out[0]["r"] is None
    assert out[1]["r"] == 0.0 and out[1]["pr"] == 2.0
    assert out[2]["r"] is None and out[2]["pr"] is None and out[2]["fin"] is None
    assert out[3]["fin"] is False
    assert out[4]["r"] == 0.0001


def test_labels_and_signals_with_nulls(spark):
    df = spark.createDataFrame(
        [(None, None, None), (1.0, 1.0, 0.0), (2.0, 1.0, -0.5), (0.5, 1.0, 60.0)],
        "close double, ma double, ret double",
    )
    got = df.select(
        ma30_signal("close", "ma").alias("sig"),
        crossover_signal("close", "ma").alias("x"),
        performance_label("ret").alias("lab"),
        direction("ret").alias("dir"),
        price_spike("ret", 0.5).alias("spike"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("AT", "NEUTRAL", "FLAT", "LOSER", False),
        ("AT", "NEUTRAL", "FLAT", "LOSER", False),
        ("ABOVE", "GOLDEN CROSS", "FLAT", "LOSER", False),
        ("BELOW", "DEATH CROSS", "STRONG GAIN", "GAINER", True),
    ]
    assert df.select(F.lit(1)).count() == 4


def test_sql_functions_agree_with_column_functions(spark):
    from scales import SF_SMALL
    from ohlcflow import queries as Q
    from ohlcflow.functions.sql import register_sql_functions

    names = register_sql_functions(spark)
    assert "performance_label" in names
    Q.q_stock_summary(spark, SF_SMALL).createOrReplaceTempView("t_summary")
    via_sql = spark.sql("""
        SELECT symbol, date, performance_label(daily_return_pct) AS lab,
               ma30_signal(close, ma_30d) AS sig, crossover_signal(ma_7d, ma_30d) AS x,
               mover_direction(daily_return_pct) AS dir
        FROM t_summary""")
    via_cols = Q.q_stock_summary(spark, SF_SMALL).select(
        "symbol", "date",
        performance_label("daily_return_pct").alias("lab"),
        ma30_signal("close", "ma_30d").alias("sig"),
        crossover_signal("ma_7d", "ma_30d").alias("x"),
        direction("daily_return_pct").alias("dir"),
    )
    assert via_sql.exceptAll(via_cols).count() == 0 and via_cols.exceptAll(via_sql).count() == 0
    assert {r[0] for r in spark.sql("SELECT dq_status(0L), dq_status(3L)").collect()[0:1]} == {"PASSED"}
    plan = via_sql._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
