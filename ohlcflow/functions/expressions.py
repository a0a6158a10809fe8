"""Column expressions shared by the operators.

All of them are built-in Spark expressions (JVM side, whole-stage codegen) and
give the same result with ``spark.sql.ansi.enabled`` on or off: every parse or
division that could fail uses a ``try_*`` form and yields NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (
    DATE_FORMAT,
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


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- parsing --------------------------------------------------------------


def parse_date(col, fmt: str = DATE_FORMAT) -> Column:
    """Strict date parse; anything that is not ``fmt`` becomes NULL."""
    return F.try_to_date(_c(col).cast("string"), fmt)


def parse_double(col) -> Column:
    """String -> double, NULL when unparseable (legacy non-ANSI cast)."""
    return _c(col).try_cast("double")


def parse_long(col) -> Column:
    """String -> long with the legacy (non-ANSI) cast semantics.

    The legacy cast accepted a decimal point and dropped the fraction
    (``'1.5'`` -> 1, ``'.5'`` -> 0, ``'5.'`` -> 5, ``'-0.5'`` -> 0) but no
    exponent (``'1e3'`` -> NULL). Plain integers take the fast path
    (``try_cast``, which trims the same characters); only what it rejects
    goes through the text rule: the fraction is cut off as text, so the
    integral part keeps full 64-bit precision and overflow still yields NULL.
    """
    raw = _c(col).cast("string")
    # the legacy cast trims every character <= ' ' (spaces, tabs, newlines)
    s = F.regexp_replace(raw, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    # '.5' -> '0.5', '-.5' -> '-0.5', '.' -> '0.'
    s = F.regexp_replace(s, r"^([+-]?)\.", "$10.")
    integral = F.when(
        s.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$"), F.regexp_replace(s, r"\.[0-9]*$", "")
    )
    return F.coalesce(raw.try_cast("long"), integral.try_cast("long"))


def is_finite(col) -> Column:
    """True for a non-NULL value that is neither NaN nor +/-Infinity."""
    c = _c(col)
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


# --- derived bar metrics --------------------------------------------------


def daily_return(open_="open", close="close") -> Column:
    """Intraday return in percent, rounded to 4 decimals; open = 0 -> NULL."""
    o, c = _c(open_), _c(close)
    return F.round(F.try_divide(c - o, o) * F.lit(100), 4)


def price_range(high="high", low="low") -> Column:
    return F.round(_c(high) - _c(low), 4)


def strictly_above(value, threshold) -> Column:
    """``value > threshold`` where a NULL comparison counts as false."""
    return F.coalesce(_c(value) > threshold, F.lit(False))


def price_spike(ret="daily_return_pct", max_pct: float = 0.50) -> Column:
    return strictly_above(F.abs(_c(ret)), F.lit(max_pct * 100))


def direction(ret="daily_return_pct") -> Column:
    """GAINER for a positive return; zero and NULL count as LOSER."""
    return F.when(_c(ret) > 0, F.lit(GAINER)).otherwise(F.lit(LOSER))


# --- signals and labels ---------------------------------------------------


def ma30_signal(close="close", ma="ma_30d") -> Column:
    c, m = _c(close), _c(ma)
    return F.when(c > m, F.lit(MA30_ABOVE)).when(c < m, F.lit(MA30_BELOW)).otherwise(F.lit(MA30_AT))


def performance_label(ret="daily_return_pct") -> Column:
    """First matching rule of ``PERFORMANCE_LABELS``; NULL falls through to FLAT."""
    r = _c(ret)
    expr = None
    for op, bound, label in PERFORMANCE_LABELS:
        cond = (r >= bound) if op == ">=" else (r <= bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(PERFORMANCE_DEFAULT))


def crossover_signal(fast="ma_7d", slow="ma_30d") -> Column:
    """A state (fast vs slow average), not an edge."""
    f, s = _c(fast), _c(slow)
    return F.when(f > s, F.lit(GOLDEN_CROSS)).when(f < s, F.lit(DEATH_CROSS)).otherwise(F.lit(NEUTRAL))


def dq_status(fail_count="fail_count", passed: str = DQ_PASSED, failed: str = DQ_FAILED) -> Column:
    return F.when(_c(fail_count) == 0, F.lit(passed)).otherwise(F.lit(failed))
