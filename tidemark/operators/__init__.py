from .bars import (BAR_COLUMNS, bar_aggregates, buy_pressure, moving_average,
                   ohlcv_bars, sliding_counts, window_counts, window_stats)
from .sessions import sessions
from .summaries import (count_rows, filter_amount, label_rows, peek, recent_bars,
                        recent_trades, side_summary, symbol_summary, time_slice,
                        top_buy_pressure)
from .upsert import check_unique_key, upsert_by_key

__all__ = [
    "BAR_COLUMNS", "bar_aggregates", "buy_pressure", "moving_average", "ohlcv_bars",
    "sliding_counts", "window_counts", "window_stats", "sessions", "count_rows",
    "filter_amount", "label_rows", "peek", "recent_bars", "recent_trades",
    "side_summary", "symbol_summary", "time_slice", "top_buy_pressure",
    "check_unique_key", "upsert_by_key",
]
