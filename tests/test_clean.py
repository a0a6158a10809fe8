import datetime as dt

import pytest
from pyspark.sql import functions as F

from ohlcflow.operators.clean import cast_schema, deduplicate, filter_valid_prices


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


class TestCastSchema:
    def test_types(self, sample_bars):
        t = dict(cast_schema(sample_bars).dtypes)
        assert (t["date"], t["open"], t["close"], t["volume"]) == ("date", "double", "double", "bigint")

    def test_no_rows_lost(self, dirty_sample):
        assert cast_schema(dirty_sample).count() == dirty_sample.count()

    @pytest.mark.parametrize("ansi", ["true", "false"])
    def test_legacy_volume_and_bad_values(self, spark, raw_bars, ansi):
        prev = spark.conf.get("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            vols = ["1.5", ".5", "5.", "1e3", "-0.5", "100.0", "", " 42 ", "9223372036854775808",
                    "n/a", "\t7\n", "+5", "-", ".", "NaN", "1,000", "0x10", "-9223372036854775808"]
            df = raw_bars([("X2", "2021-3-5", "1", "2", "0.5", "n/a", v) for v in vols])
            out = cast_schema(df).collect()
            assert [r["volume"] for r in out] == [
                1, 0, 5, None, 0, 100, None, 42, None, None, 7, 5, None, 0, None, None, None,
                -9223372036854775808,
            ]
            assert all(r["date"] is None and r["close"] is None for r in out)
        finally:
            spark.conf.set("spark.sql.ansi.enabled", prev)

    def test_strict_date(self, raw_bars):
        df = raw_bars([("A", d, "1", "1", "1", "1", "1") for d in ["2021-03-05", "2021-3-5", "not-a-date"]])
        assert [r["date"] for r in cast_schema(df).collect()] == [dt.date(2021, 3, 5), None, None]


class TestFilterValid:
    def test_rules(self, raw_bars):
        rows = [
            ("OK", "2021-03-01", "50", "52", "49", "51", "100"),
            ("ZERO_VOL", "2021-03-02", "50", "50", "50", "50", "0"),
            ("NEG", "2021-03-03", "-1", "52", "49", "51", "100"),
            ("ZERO", "2021-03-04", "0", "52", "49", "51", "100"),
            ("HL", "2021-03-05", "10", "9", "10", "10", "100"),
            ("NAN", "2021-03-06", "10", "11", "9", "NaN", "100"),
            ("BADNUM", "2021-03-07", "10", "11", "9", "n/a", "100"),
            ("EMPTYVOL", "2021-03-08", "10", "11", "9", "10", ""),
            ("DECVOL", "2021-03-09", "10", "11", "9", "10", "100.0"),
            (None, "2021-03-10", "10", "11", "9", "10", "1"),
            ("BADDATE", "2021-3-5", "10", "11", "9", "10", "1"),
        ]
        out = filter_valid_prices(cast_schema(raw_bars(rows)))
        kept = sorted((r["symbol"] or "<null>") for r in out.collect())
        assert kept == sorted(["OK", "ZERO_VOL", "DECVOL", "<null>", "BADDATE"])

    def test_reference_nan_mode(self, raw_bars):
        # plain comparison keeps NaN (NaN sorts above every number); the
        # default also rejects non-finite prices
        rows = [("N", "2021-03-06", "10", "11", "9", "NaN", "100"),
                ("I", "2021-03-06", "10", "Infinity", "9", "10", "100")]
        typed = cast_schema(raw_bars(rows))
        assert filter_valid_prices(typed).count() == 0
        assert sorted(r["symbol"] for r in filter_valid_prices(typed, finite_only=False).collect()) == ["I", "N"]

    def test_dirty_fixture(self, dirty_sample):
        out = filter_valid_prices(cast_schema(dirty_sample))
        assert out.filter((F.col("open") <= 0) | (F.col("high") < F.col("low"))).count() == 0
        assert out.count() == 3

    def test_clean_rows_kept(self, sample_bars):
        df = cast_schema(sample_bars)
        assert filter_valid_prices(df).count() == df.count()


class TestDeduplicate:
    def test_exact_duplicate(self, dirty_sample):
        out = deduplicate(cast_schema(dirty_sample))
        assert out.groupBy("symbol", "date").count().filter("count > 1").count() == 0
        assert out.count() == 4

    def test_conflicting_duplicate_is_order_independent(self, raw_bars):
        rows = [("A", "2021-01-04", o, "20", "1", "5", "7") for o in ["3", "1", "2"]]
        for perm in (rows, rows[::-1], rows[1:] + rows[:1]):
            df = cast_schema(raw_bars(perm)).repartition(3)
            assert _rows(deduplicate(df), "open") == [(1.0,)]

    def test_bad_duplicate_first(self, raw_bars):
        rows = [
            ("A", "2021-01-04", "-1", "20", "1", "5", "7"),
            ("A", "2021-01-04", "4", "20", "1", "5", "7"),
        ]
        out = deduplicate(filter_valid_prices(cast_schema(raw_bars(rows))))
        assert _rows(out, "open") == [(4.0,)]

    def test_null_keys_compare_equal(self, raw_bars):
        rows = [(None, "bad", "2", "3", "1", "2", "1"), (None, "worse", "1", "3", "1", "2", "1")]
        out = deduplicate(cast_schema(raw_bars(rows)))
        assert _rows(out, "symbol", "date", "open") == [(None, None, 1.0)]

    def test_batch_number_orders_first(self, raw_bars):
        df = cast_schema(
            raw_bars([("A", "2021-01-04", "1", "3", "1", "2", "1"), ("A", "2021-01-04", "2", "3", "1", "2", "1")])
        ).withColumn("_batch_number", F.when(F.col("open") == 1, 2).otherwise(1))
        assert _rows(deduplicate(df), "open") == [(2.0,)]

    def test_unique_rows_kept(self, sample_bars):
        df = cast_schema(sample_bars)
        assert deduplicate(df).count() == df.count()
