"""Summarise the physical plan of every registered query into PLANS.md.

Usage: python tests/plan_report.py [sf_dir] [out_md]

Per query: shuffles (hash / range / single partition), broadcasts, scans and
the columns they read, pushed/partition filters, partial top-k
(WindowGroupLimit), aggregate kinds, window operators and how many operators
run inside whole-stage codegen. Plans are the adaptive final plans after the
DataFrame has been executed.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _final_tree_and_details(plan: str) -> tuple[str, str]:
    """The operator tree of the final adaptive plan (or the only plan) and
    the detail blocks of exactly its operators."""
    if "== Final Plan ==" in plan:
        tree = plan.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    else:
        tree = plan.split("\n\n(1)")[0]
    ids = set(re.findall(r"\((\d+)\)", tree))
    blocks = []
    for block in (b.strip("\n") for b in plan.split("\n\n")):
        m = re.match(r"\((\d+)\) ", block)
        if m and m.group(1) in ids:
            blocks.append(block)
    return tree, "\n\n".join(blocks)


def summarise(plan: str) -> dict:
    tree, details = _final_tree_and_details(plan)
    return {
        "hash_exchanges": len(re.findall(r"Arguments: hashpartitioning", details)),
        "range_exchanges": len(re.findall(r"Arguments: rangepartitioning", details)),
        "single_partition": len(re.findall(r"Arguments: SinglePartition", details)),
        "broadcasts": len(re.findall(r"BroadcastExchange \(", tree)),
        "scans": len(re.findall(r"Scan parquet", tree)),
        "read_schema": sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", details))),
        "window_group_limit": len(re.findall(r"WindowGroupLimit \(", tree)),
        "windows": len(re.findall(r"\bWindow \(", tree)),
        "hash_aggregates": len(re.findall(r"HashAggregate \(", tree)),
        "sort_aggregates": len(re.findall(r"SortAggregate \(", tree)),
        "joins": [f"{a} {b}" for a, b in re.findall(r"(\w+Join) (\w+)", tree)],
        # operators inside whole-stage codegen ("*" in the tree) / all operators
        "codegen": (
            len(re.findall(r"\* \w", tree)),
            len(re.findall(r"\w \(\d+\)", tree)),
        ),
    }


def _scan_lines(plan: str) -> list[str]:
    keep = ("PartitionFilters", "PushedFilters", "ReadSchema", "Location")
    out = []
    for block in (b.strip("\n") for b in plan.split("\n\n")):
        if "Scan parquet" in block.split("\n")[0]:
            out += [ln for ln in block.split("\n")[1:] if ln.startswith(keep)]
    return out


def _layer_examples(spark, sf_dir: str) -> list[str]:
    from pyspark.sql import functions as F

    from ohlcflow import queries as Q
    from ohlcflow.operators.signals import sma, top_gains
    from ohlcflow.operators.views import vw_stock_summary
    from ohlcflow.plans.layers import register_sql_layer, run_layers
    from ohlcflow.plans.storage import scratch_path
    from ohlcflow.schemas import BAR_FIELDS

    raw = Q.clean_bars(spark, sf_dir).select(*[F.col(c).cast("string") for c in BAR_FIELDS])
    res = run_layers(spark, raw, scratch_path(spark, "plan-layers"), expected_symbols=["S00"],
                     min_rows=1)
    t = register_sql_layer(spark, res)
    examples = {
        "sma(stock_summary, 7, symbol='S07')": sma(t["stock_summary"], 7, symbol="S07"),
        "top_gains(vw_stock_summary, symbol='S07')": top_gains(t["vw_stock_summary"], "S07"),
        "vw_stock_summary where date >= 2000-01-01": vw_stock_summary(t["stock_summary"]).filter(
            F.col("date") >= F.lit("2000-01-01").cast("date")
        ),
        "silver where close > 150 (columns symbol, date, close)": t["stock_prices_silver"]
        .filter(F.col("close") > 150).select("symbol", "date", "close"),
    }
    out = []
    for name, df in examples.items():
        out += [f"### {name}", "", "```"] + _scan_lines(formatted_plan(df)) + ["```", ""]
    return out


def main():
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"
    )
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as E

    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tests/plan_report.py` on `{sf_dir}` (adaptive final plans,"
        " local[8]), after executing each query. The inputs are the tables written once from `lineitem` (clean bars, raw dirty bars). \"codegen ops\": operators inside whole-stage codegen / all plan nodes (exchanges, query stages and windows never are).",
        "",
        "| query | hash shuffles | range shuffles | single-partition | broadcasts | scans |"
        " partial+final top-k | windows | hash / sort aggs | joins | codegen ops |",
        "|---|---|---|---|---|---|---|---|---|---|---|",
    ]
    details = []
    for name, fn in E.queries().items():
        df = fn(spark, sf_dir)
        df.collect()  # execute this DataFrame's own plan, so explain shows the final plan
        plan = formatted_plan(df)
        s = summarise(plan)
        lines.append(
            f"| {name} | {s['hash_exchanges']} | {s['range_exchanges']} | {s['single_partition']} |"
            f" {s['broadcasts']} | {s['scans']} | {s['window_group_limit']} | {s['windows']} |"
            f" {s['hash_aggregates']} / {s['sort_aggregates']} | {', '.join(s['joins']) or '-'} |"
            f" {s['codegen'][0]} / {s['codegen'][1]} |"
        )
        details.append(f"### {name}\n\nReadSchema: " + "; ".join(f"`{r}`" for r in s["read_schema"]))
    lines += ["", "## Filters reaching the scan (library calls on written layers)", ""]
    lines += _layer_examples(spark, sf_dir)
    lines += ["", "## Columns read per query", ""] + details
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(f"wrote {out}")
    spark.stop()


if __name__ == "__main__":
    main()
