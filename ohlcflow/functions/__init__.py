"""Scalar column expressions (built-in Spark functions only)."""

from .expressions import (  # noqa: F401
    crossover_signal,
    daily_return,
    direction,
    dq_status,
    is_finite,
    ma30_signal,
    parse_date,
    parse_double,
    parse_long,
    performance_label,
    price_range,
    price_spike,
    strictly_above,
)
