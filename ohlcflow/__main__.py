"""Command line: run one step of the bar layers, or all of them.

    python -m ohlcflow chain   --csv DIR --out ROOT [--expected A,B] [--checks c1,c2]
    python -m ohlcflow produce --csv DIR --messages DIR
    python -m ohlcflow consume --messages DIR --out ROOT [--files-per-trigger N]
    python -m ohlcflow silver  --out ROOT            # ROOT/bronze -> ROOT/silver
    python -m ohlcflow gold    --out ROOT [--expected ...] [--checks ...]
    python -m ohlcflow sql     --out ROOT [--symbol S]

The master and cluster settings come from ``spark-submit`` (or ``--master``);
``--format`` names the table format of the layers (default parquet).
Layer locations: ROOT/bronze/stock_prices, ROOT/silver/stock_prices,
ROOT/gold/{stock_summary,top_movers,volume_analysis}.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .operators.quality import assert_quality, dq_report
from .plans.layers import (
    LayerResult,
    bronze_to_silver,
    consume_messages,
    layer_paths,
    produce_messages,
    run_chain,
    run_sql_layer,
    silver_to_gold,
)
from .schemas import BRONZE_SCHEMA, EXPECTED_SYMBOLS
from .sources.tables import read_partitioned, read_table


def _list(v: str | None, default=None):
    return [x for x in v.split(",") if x] if v else default


def _session(master: str | None) -> SparkSession:
    b = SparkSession.builder.appName("ohlcflow").config("spark.sql.session.timeZone", "UTC")
    if master:
        b = b.master(master)
    return b.getOrCreate()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m ohlcflow")
    ap.add_argument("step", choices=["chain", "produce", "consume", "silver", "gold", "sql"])
    ap.add_argument("--csv")
    ap.add_argument("--messages")
    ap.add_argument("--out")
    ap.add_argument("--expected", help="comma-separated expected symbols")
    ap.add_argument("--checks", help="comma-separated gate checks (default: all seven)")
    ap.add_argument("--files-per-trigger", type=int)
    ap.add_argument("--symbol")
    ap.add_argument("--master")
    ap.add_argument("--format", default="parquet", help="table format of the layers")
    ap.add_argument("--segmented", choices=["no", "yes", "auto"], default="no",
                    help="per-symbol window plan for very long series")
    a = ap.parse_args(argv)
    spark = _session(a.master)
    expected = _list(a.expected, EXPECTED_SYMBOLS)
    checks = _list(a.checks)
    paths = layer_paths(a.out) if a.out else {}
    segmented = {"no": False, "yes": True, "auto": "auto"}[a.segmented]

    if a.step == "chain":
        res, _ = run_chain(spark, a.out, csv_path=a.csv, expected_symbols=expected,
                           gate_checks=checks, max_files_per_trigger=a.files_per_trigger,
                           fmt=a.format)
        print(res.counts)
    elif a.step == "produce":
        produce_messages(spark, a.messages, csv_path=a.csv)
    elif a.step == "consume":
        consume_messages(spark, a.messages, a.out, a.files_per_trigger, fmt=a.format)
    elif a.step == "silver":
        bronze = read_table(spark, paths["bronze"], BRONZE_SCHEMA, a.format)
        res = LayerResult({"silver": paths["silver"]})
        bronze_to_silver(spark, bronze, paths["silver"], fmt=a.format, result=res)
        print(res.counts)
    elif a.step == "gold":
        silver = read_partitioned(spark, paths["silver"], a.format)
        assert_quality(dq_report(silver, expected), checks)
        print(silver_to_gold(silver, paths, fmt=a.format, segmented=segmented).counts)
    elif a.step == "sql":
        res = LayerResult({k: v for k, v in paths.items() if k != "bronze"})
        for name, df in run_sql_layer(spark, res, a.symbol, fmt=a.format).items():
            print(f"-- {name}")
            df.show(truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
