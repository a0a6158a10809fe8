"""Property tests: generated inputs checked against small Python models."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ohlcflow.functions.expressions import parse_long
from ohlcflow.operators.clean import deduplicate

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def legacy_long(s: str | None):
    """Model of the non-ANSI string -> long cast: trim control characters and
    spaces, optional sign, digits, optional '.' with digits that are dropped;
    anything else or an overflow gives NULL."""
    if s is None:
        return None
    t = s.strip("".join(chr(c) for c in range(33)))
    if not t:
        return None
    neg = t[0] == "-"
    if t[0] in "+-":
        t = t[1:]
        if not t:
            return None
    whole, dot, frac = t.partition(".")
    if not all(c.isdigit() and c.isascii() for c in whole):
        return None
    if dot and not all(c.isdigit() and c.isascii() for c in frac):
        return None
    if not whole and not dot:
        return None
    v = int(whole) if whole else 0
    v = -v if neg else v
    return v if LONG_MIN <= v <= LONG_MAX else None


texts = st.text(alphabet="0123456789.+-e \t", max_size=22) | st.sampled_from(
    ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809"]
)


@settings(max_examples=25, deadline=None)
@given(st.lists(texts, min_size=1, max_size=60))
def test_parse_long_matches_legacy_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r["x"] for r in df.select(parse_long("v").alias("x")).collect()]
    assert got == [legacy_long(v) for v in values]


rows = st.lists(
    st.tuples(st.sampled_from(["A", "B", None]), st.integers(1, 3), st.integers(0, 4), st.integers(0, 2)),
    min_size=1, max_size=40,
)


@settings(max_examples=15, deadline=None)
@given(rows, st.integers(1, 5))
def test_dedup_is_the_minimum_per_key(spark, data, parts):
    df = spark.createDataFrame(data, "symbol string, date int, open int, volume int").repartition(parts)
    got = sorted(
        (tuple(r) for r in deduplicate(df, ["symbol", "date"], [F.col("open"), F.col("volume")]).collect()),
        key=repr,
    )
    best = {}
    for s, d, o, v in data:
        k = (s, d)
        if k not in best or (o, v) < best[k][2:]:
            best[k] = (s, d, o, v)
    assert got == sorted(best.values(), key=repr)


series = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 60), st.integers(1, 1000)),
    min_size=1, max_size=80, unique_by=lambda t: (t[0], t[1]),
)


@settings(max_examples=16, deadline=None)
@given(series, st.integers(1, 6), st.integers(2, 9), st.sampled_from([None, 1, 7, 20]))
def test_segmented_window_equals_direct(spark, data, n, block, bucket):
    from pyspark.sql import Window

    from ohlcflow.plans.skew import segmented_trailing_avg

    block = max(block, n - 1, 1)
    df = spark.createDataFrame(data, "symbol string, t int, v int")
    seg = segmented_trailing_avg(
        df, {"a": ("v", n)}, key="symbol", order="t", block_rows=block,
        bucket=None if bucket is None else F.floor(F.col("t") / bucket),
    )
    w = Window.partitionBy("symbol").orderBy("t").rowsBetween(1 - n, 0)
    direct = df.withColumn("a", F.avg("v").over(w))
    assert sorted(map(tuple, seg.collect())) == sorted(map(tuple, direct.collect()))


dq_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", None]),
        st.sampled_from([1, 2, None]),
        st.sampled_from([-1.0, 0.0, 1.0, 5.0, None]),
        st.sampled_from([0.5, 2.0, None]),
    ),
    max_size=40,
)


@settings(max_examples=15, deadline=None)
@given(dq_rows, st.lists(st.sampled_from(["A", "B", "Z", None]), max_size=4), st.integers(1, 4))
def test_dq_report_matches_model(spark, rows, expected, min_rows):
    from collections import Counter

    from ohlcflow.operators.quality import dq_report

    df = spark.createDataFrame(
        [(s, d, o, h, 1.0, 1.0) for s, d, o, h in rows],
        "symbol string, date int, open double, high double, low double, close double",
    )
    got = {r["check_name"]: r["fail_count"] for r in dq_report(df, expected, min_rows).collect()}
    keys = Counter((s, d) for s, d, _, _ in rows)
    per_symbol = Counter(s for s, _, _, _ in rows)
    present = {s for s, _, _, _ in rows if s is not None}

    def le0(x):
        return x is not None and x <= 0

    want = {
        "null_symbols": sum(s is None for s, _, _, _ in rows),
        "null_dates": sum(d is None for _, d, _, _ in rows),
        "negative_prices": sum(le0(o) or le0(h) for _, _, o, h in rows),
        "high_lt_low": sum(h is not None and h < 1.0 for _, _, _, h in rows),
        "duplicates": sum(c > 1 for c in keys.values()),
        "missing_symbols": sum(e is None or e not in present for e in expected),
        "low_row_count": sum(c < min_rows for c in per_symbol.values()),
    }
    assert got == want


FIELDS = ["date", "open", "high", "low", "close", "volume"]
header_specs = st.lists(
    st.tuples(
        st.lists(
            st.tuples(st.sampled_from(FIELDS + ["OpenInt", "Adj Close"]),
                      st.sampled_from(["cap", "low", "both"])),
            min_size=1, max_size=7,
        ),
        st.integers(1, 3),
    ),
    min_size=1, max_size=3,
)


def _header_cells(spec):
    cells = []
    for name, case in spec:
        if name not in FIELDS:
            cells.append(name)
        elif case == "cap":
            cells.append(name.capitalize())
        elif case == "low":
            cells.append(name)
        else:
            cells += [name, name.capitalize()]
    return cells


def _model_row(header, values):
    """Name lookup as a dict (a later duplicate overrides), capitalised
    spelling first, defaults for fields the header lacks."""
    row = dict(zip(header, values))
    out = []
    for f in FIELDS:
        cap = f.capitalize()
        if cap in row:
            out.append(row[cap])
        elif f in row:
            out.append(row[f])
        else:
            out.append("" if f == "date" else "0")
    return tuple(out)


@settings(max_examples=10, deadline=None)
@given(header_specs)
def test_csv_scan_matches_name_model(spark, files):
    import os

    from ohlcflow.plans.storage import scratch_path
    from ohlcflow.sources.csv import scan_csv

    root = scratch_path(spark, "csv-prop")
    want = []
    for i, (spec, n_rows) in enumerate(files):
        header = _header_cells(spec)
        os.makedirs(f"{root}/symbol=F{i}")
        lines = [",".join(header)]
        for r in range(n_rows):
            values = [f"v{i}_{r}_{c}" for c in range(len(header))]
            lines.append(",".join(values))
            want.append((f"F{i}",) + _model_row(header, values))
        with open(f"{root}/symbol=F{i}/part.csv", "w") as fh:
            fh.write("\n".join(lines) + "\n")
    got = [tuple(r) for r in scan_csv(spark, root).collect()]
    assert sorted(got) == sorted(want)


msg_values = st.one_of(
    st.dictionaries(
        st.sampled_from(["symbol", "date", "open", "high", "low", "close", "volume", "extra"]),
        st.one_of(st.text(alphabet="AZ09.-", max_size=6), st.integers(0, 999), st.none()),
        max_size=8,
    ).map(lambda d: __import__("json").dumps(d)),
    st.sampled_from(["not json", "{", "[]", ""]),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(msg_values, min_size=1, max_size=25))
def test_decode_messages_matches_json_model(spark, values):
    import json

    from ohlcflow.schemas import BAR_FIELDS
    from ohlcflow.sources.messages import decode_messages, message_rejects

    def model(v):
        try:
            obj = json.loads(v)
        except ValueError:
            return None
        if not isinstance(obj, dict):
            return None
        return tuple(None if obj.get(f) is None else str(obj[f]) for f in BAR_FIELDS)

    df = spark.createDataFrame([(v,) for v in values], "value string")
    want = [m for m in map(model, values) if m is not None]
    got = [tuple(r) for r in decode_messages(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert message_rejects(df).count() == len(values) - len(want)


mover_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C", "D"]),
        st.sampled_from([1, 2, None]),
        st.sampled_from([-60.0, -3.5, -1.0, 0.0, 1.0, 2.5, 2.5, 60.0, None]),
    ),
    max_size=30,
)


@settings(max_examples=15, deadline=None)
@given(mover_rows, st.integers(1, 3))
def test_top_movers_matches_dense_rank_model(spark, rows, top_n):
    from ohlcflow.operators.marts import top_movers

    df = spark.createDataFrame(
        [(s, d, r, abs(r) > 50 if r is not None else False, 1.0, 1) for s, d, r in rows],
        "symbol string, date int, daily_return_pct double, price_spike_flag boolean, "
        "close double, volume bigint",
    )
    kept = [(s, d, r) for s, d, r in rows if not (r is not None and abs(r) > 50)]
    groups: dict = {}
    for s, d, r in kept:
        groups.setdefault((d, "GAINER" if (r is not None and r > 0) else "LOSER"), []).append((s, r))
    want = []
    for (d, direction), members in groups.items():
        distinct = sorted({abs(r) for _, r in members if r is not None}, reverse=True)
        ranks = {v: i + 1 for i, v in enumerate(distinct)}
        null_rank = len(distinct) + 1
        for s, r in members:
            rank = ranks[abs(r)] if r is not None else null_rank
            if rank <= top_n:
                want.append((d, s, direction, r, rank))
    for ties in ("window", "join"):
        got = [
            (x["date"], x["symbol"], x["direction"], x["daily_return_pct"], x["rank"])
            for x in top_movers(df, top_n, ties=ties).collect()
        ]
        assert sorted(got, key=repr) == sorted(want, key=repr), ties
