"""DataFrame -> DataFrame operators on bar tables."""

from .clean import cast_schema, deduplicate, filter_valid_prices  # noqa: F401
from .features import (  # noqa: F401
    add_daily_return,
    add_moving_average,
    add_moving_averages,
    add_price_range,
    add_price_spike_flag,
    add_volume_spike_flag,
)
from .marts import stock_summary, top_movers, volume_analysis  # noqa: F401
from .quality import (  # noqa: F401
    GATE_CHECKS,
    RUNNER_CHECKS,
    QualityGateError,
    assert_quality,
    dq_duplicates,
    dq_low_rows,
    dq_report,
    missing_symbols,
)
from .signals import (  # noqa: F401
    crossover,
    crossover_join,
    latest_signal,
    sma,
    top_gains,
    top_volume_spikes,
)
from .views import register_views, vw_stock_summary, vw_top_movers, vw_volume_spikes  # noqa: F401
