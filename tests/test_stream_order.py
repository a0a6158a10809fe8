"""Record-accurate CSV and the bounded consume in stream order."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from ohlcflow.plans.storage import scratch_path
from ohlcflow.sources.csv import bar_records, scan_csv
from ohlcflow.sources.messages import decode_messages, first_messages, message_table, topic_order


def dict_reader(text):
    """The cells by header name, capitalised first, as a dictionary reader gives them."""
    out = []
    for row in csv.DictReader(io.StringIO(text, newline="")):
        cells = []
        for name, default in (("date", ""), ("open", "0"), ("high", "0"), ("low", "0"), ("close", "0"), ("volume", "0")):
            value = row.get(name.capitalize(), row.get(name, default))
            cells.append(value)
        out.append(cells)
    return out


@pytest.mark.parametrize(
    "text",
    [
        'Date,Note,Close\n2024-01-01,"a\nb,""c""\n\n",5\n2024-01-02,,6\n',
        'Note,date,close\r\n"x\r\ny",2024-01-01,5\r\n\r\n"",2024-01-02,7',
        "close,Close,date\n1,2,2024-01-01\n",
        'date,close\n2024-01-01,"4"\n2024-01-02\n2024-01-03,5,6,7\n',
        "a,b\n1,2\n",
        'date,close\n"2024-01-01',
    ],
)
def test_records_equal_a_dictionary_reader(text):
    got = [["" if c is None else c for c in row] for row in bar_records(text)]
    assert got == [["" if c is None else c for c in row] for row in dict_reader(text)]


def test_empty_and_blank_files():
    assert list(bar_records("")) == [] and list(bar_records("date,close\n")) == [] and list(bar_records("date\n\n  \n")) == []
    assert list(bar_records("\n2024-01-01,1\n")) == [["", "0", "0", "0", "0", "0"]]


def test_quoted_line_breaks_in_a_scan(spark):
    root = scratch_path(spark, "csv-quoted")
    for symbol, text in (("A%2FB", 'Note,Date,Close\n"one\ntwo, ""x""\n",2024-01-01,5\n"",2024-01-02,6\n'), ("007", "Date,Close\n2024-01-01,7\n"), ("a+b", "Date,Close\n2024-01-01,8\n"), ("__HIVE_DEFAULT_PARTITION__", "Date,Close\n2024-01-01,9\n")):
        os.makedirs(f"{root}/symbol={symbol}")
        with open(f"{root}/symbol={symbol}/x.csv", "w", newline="") as f:
            f.write(text)
    got = sorted((r.symbol or "", r.date, r.close) for r in scan_csv(spark, root).collect())
    assert got == [("", "2024-01-01", "9"), ("007", "2024-01-01", "7"), ("A/B", "2024-01-01", "5"), ("A/B", "2024-01-02", "6"), ("a+b", "2024-01-01", "8")]


def test_many_rows_leave_in_batches(spark):
    root = scratch_path(spark, "csv-long")
    os.makedirs(f"{root}/symbol=L")
    with open(f"{root}/symbol=L/x.csv", "w") as f:
        f.write("date,close\n" + "".join(f"2024-01-01,{i}\n" for i in range(25_000)))
    got = scan_csv(spark, root).agg(F.count("*"), F.sum(F.col("close").cast("int"))).first()
    assert tuple(got) == (25_000, sum(range(25_000)))


@pytest.fixture
def feed(spark):
    src = scratch_path(spark, "bounded")
    os.makedirs(src)
    lines = []
    for i in range(6):
        part = [f'{{"symbol":"S","volume":"{i * 100 + k}"}}' for k in range([40, 0, 7, 1, 90, 12][i])]
        with open(f"{src}/part-{i}.json", "w") as f:
            f.write("".join(x + "\n" for x in part))
        lines += part
    return src, lines


@pytest.mark.parametrize("n", [0, 1, 40, 41, 47, 48, 100, 150, 1000])
def test_the_first_messages_in_file_order(spark, feed, n):
    src, lines = feed
    got = first_messages(message_table(spark, src), n)
    assert sorted(r["value"] for r in got.collect()) == sorted(lines[:n])


def test_file_splits_keep_the_order(spark, feed):
    src, lines = feed
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")  # several splits a file
    try:
        assert message_table(spark, src).select("_file", "_start").distinct().count() > 8
        for n in (30, 60):
            assert sorted(r["value"] for r in first_messages(message_table(spark, src), n).collect()) == sorted(lines[:n])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_topic_order_and_decode(spark, feed):
    src, lines = feed
    rng = random.Random(1)
    rows = [(p, o, f'{{"symbol":"{p}","volume":"{o}"}}') for p in (0, 2, 10) for o in rng.sample(range(200_000), 50)]
    rng.shuffle(rows)
    topic = topic_order(spark.createDataFrame(rows, "partition int, offset long, value string"))
    for n in (20, 50, 70, 149):
        got = {(int(r.symbol), int(r.volume)) for r in decode_messages(topic, max_messages=n).collect()}
        assert got == {(p, o) for p, o, _ in sorted(rows)[:n]}
    bounded = decode_messages(message_table(spark, src), max_messages=60)
    assert bounded.count() == 60
    assert first_messages(message_table(spark, src), 140).count() == 140
