from .tables import TABLES, load_table
from .trades import (BUY, SELL, TRADE_COLUMNS, TRADE_SCHEMA, TRADES_SQL,
                     load_trades, project_trades, trades_from_events)

__all__ = ["TABLES", "load_table", "BUY", "SELL", "TRADE_COLUMNS", "TRADE_SCHEMA",
           "TRADES_SQL", "load_trades", "project_trades", "trades_from_events"]
