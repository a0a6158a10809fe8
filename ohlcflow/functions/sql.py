"""The label and signal rules as session SQL functions.

``register_sql_functions(spark)`` creates temporary SQL functions (SQL
bodies, no Python: Spark inlines them into the plan) so that SQL text over
the registered views can use the same rules as the DataFrame operators:

    SELECT symbol, performance_label(daily_return_pct) FROM stock_summary

The bodies are generated from the same fixed values as the Column
functions in :mod:`ohlcflow.functions.expressions`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import (
    DEATH_CROSS,
    DQ_FAILED,
    DQ_PASSED,
    GAINER,
    GOLDEN_CROSS,
    LOSER,
    MA30_ABOVE,
    MA30_AT,
    MA30_BELOW,
    NEUTRAL,
    PERFORMANCE_DEFAULT,
    PERFORMANCE_LABELS,
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_function_definitions() -> dict[str, str]:
    """Function name -> ``CREATE TEMPORARY FUNCTION`` statement."""
    label_cases = " ".join(
        f"WHEN r {op} {bound} THEN {_q(label)}" for op, bound, label in PERFORMANCE_LABELS
    )
    return {
        "performance_label": (
            "CREATE OR REPLACE TEMPORARY FUNCTION performance_label(r DOUBLE) RETURNS STRING "
            f"RETURN CASE {label_cases} ELSE {_q(PERFORMANCE_DEFAULT)} END"
        ),
        "ma30_signal": (
            "CREATE OR REPLACE TEMPORARY FUNCTION ma30_signal(close DOUBLE, ma DOUBLE) "
            f"RETURNS STRING RETURN CASE WHEN close > ma THEN {_q(MA30_ABOVE)} "
            f"WHEN close < ma THEN {_q(MA30_BELOW)} ELSE {_q(MA30_AT)} END"
        ),
        "crossover_signal": (
            "CREATE OR REPLACE TEMPORARY FUNCTION crossover_signal(fast DOUBLE, slow DOUBLE) "
            f"RETURNS STRING RETURN CASE WHEN fast > slow THEN {_q(GOLDEN_CROSS)} "
            f"WHEN fast < slow THEN {_q(DEATH_CROSS)} ELSE {_q(NEUTRAL)} END"
        ),
        "mover_direction": (
            "CREATE OR REPLACE TEMPORARY FUNCTION mover_direction(r DOUBLE) RETURNS STRING "
            f"RETURN CASE WHEN r > 0 THEN {_q(GAINER)} ELSE {_q(LOSER)} END"
        ),
        "dq_status": (
            "CREATE OR REPLACE TEMPORARY FUNCTION dq_status(n BIGINT) RETURNS STRING "
            f"RETURN CASE WHEN n = 0 THEN {_q(DQ_PASSED)} ELSE {_q(DQ_FAILED)} END"
        ),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions in ``spark``; returns their names."""
    defs = sql_function_definitions()
    for stmt in defs.values():
        spark.sql(stmt)
    return list(defs)
