"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator,
and for each deterministic one the DuckDB SQL that must give the same rows.

Every query reads the stored tables (or data Spark derives from them) in
full.  Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import operators as ops
from .functions.ordering import first_value, last_value
from .functions.time import clock_label, to_ntz
from .operators.checks import reconcile_bars
from .plans import bucketed as buck
from .plans import catalog as cat
from .plans import layout as lay
from .plans.versioned import VersionedTable
from .session import scratch_path
from .sources import messages as msg
from .sources.objects import list_objects, table_has_files
from .sources.tables import load_table
from .sources.trades import TRADES_SQL, load_trades, project_trades, trades_from_events
from .streaming import lateness as late
from .streaming import jobs as sp
from .streaming import state as st

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _trades(spark, sf):
    return load_trades(spark, sf)


def _out_trades(df: DataFrame) -> DataFrame:
    """Raw-trade columns with the event time as a zone-free timestamp."""
    return df.select("symbol", "ts", "price", "qty", "side", to_ntz("event_time").alias("event_time"))


def with_trades(body: str, ctes: str = "") -> str:
    """Prefix the shared trades CTE (and any further CTEs) to a query."""
    more = f",\n{ctes}" if ctes else ""
    return f"WITH {TRADES_SQL}{more}\n{body}"


_HALF = "2024-01-16 00:00:00"  # cuts the events into two stretches of time

# ---------------------------------------------------------------- step 0
register("project_trades", with_trades("SELECT symbol, ts, price, qty, side, event_time FROM trades"))(
    lambda s, sf: _out_trades(project_trades(_trades(s, sf))))

register("with_event_time", with_trades("SELECT seq, ts, event_time FROM trades"))(
    lambda s, sf: _trades(s, sf).select("seq", "ts", to_ntz("event_time").alias("event_time")))

# ---------------------------------------------------------------- step 1: bars
_BAR_SQL = """
SELECT symbol,
       date_trunc('{unit}', event_time) AS window_start,
       date_trunc('{unit}', event_time) + INTERVAL 1 {unit} AS window_end,
       arg_min(price, (ts, seq)) AS open_price,
       max(price) AS high_price,
       min(price) AS low_price,
       arg_max(price, (ts, seq)) AS close_price,
       CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS total_qty,
       count(*) AS trade_count,
       CAST(sum(CAST(CASE WHEN side = 'BUY' THEN qty ELSE 0 END AS DECIMAL(18,4))) AS DOUBLE) AS buy_qty,
       CAST(sum(CAST(CASE WHEN side = 'SELL' THEN qty ELSE 0 END AS DECIMAL(18,4))) AS DOUBLE) AS sell_qty
FROM trades
WHERE event_time IS NOT NULL
GROUP BY symbol, date_trunc('{unit}', event_time)"""

register("ohlcv_bars_1m", with_trades(_BAR_SQL.format(unit="minute")))(
    lambda s, sf: ops.ohlcv_bars(_trades(s, sf), "1 minute"))
register("ohlcv_bars_1h", with_trades(_BAR_SQL.format(unit="hour")))(
    lambda s, sf: ops.ohlcv_bars(_trades(s, sf), "1 hour"))

register("first_value", with_trades("SELECT symbol, arg_min(price, (ts, seq)) AS first_price FROM trades GROUP BY symbol"))(
    lambda s, sf: _trades(s, sf).groupBy("symbol").agg(first_value("price").alias("first_price")))
register("last_value", with_trades("SELECT symbol, arg_max(price, (ts, seq)) AS last_price FROM trades GROUP BY symbol"))(
    lambda s, sf: _trades(s, sf).groupBy("symbol").agg(last_value("price").alias("last_price")))

# ---------------------------------------------------------------- step 2: ad-hoc SQL set
register("count_rows", with_trades("SELECT count(*) AS total_trades FROM trades"))(
    lambda s, sf: ops.count_rows(_trades(s, sf), "total_trades"))

register("count_bars", with_trades(f"SELECT count(*) AS total_windows FROM ({_BAR_SQL.format(unit='minute')})"))(
    lambda s, sf: ops.count_rows(ops.ohlcv_bars(_trades(s, sf)), "total_windows"))

register("symbol_summary", with_trades("""
SELECT symbol, count(*) AS trade_count,
       CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS total_volume,
       CAST(sum(CAST(price AS DECIMAL(18,4))) AS DOUBLE) / count(price) AS avg_price
FROM trades GROUP BY symbol"""))(lambda s, sf: ops.symbol_summary(_trades(s, sf)))

register("side_summary", with_trades("""
SELECT side, count(*) AS trade_count,
       CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS total_volume
FROM trades GROUP BY side"""))(lambda s, sf: ops.side_summary(_trades(s, sf)))

register("recent_trades", with_trades("""
SELECT symbol, ts, price, qty, side, event_time FROM trades
ORDER BY ts DESC, seq DESC LIMIT 10"""))(
    lambda s, sf: _out_trades(ops.recent_trades(_trades(s, sf), 10)))

register("recent_bars", with_trades(f"""
SELECT * FROM ({_BAR_SQL.format(unit='minute')})
ORDER BY window_start DESC, symbol LIMIT 10"""))(
    lambda s, sf: ops.recent_bars(ops.ohlcv_bars(_trades(s, sf)), 10))

_OHLCV_COLS = ["symbol", "window_start", "open_price", "high_price", "low_price",
               "close_price", "total_qty", "trade_count"]
register("recent_ohlcv", with_trades(f"""
SELECT {', '.join(_OHLCV_COLS)} FROM ({_BAR_SQL.format(unit='minute')})
ORDER BY window_start DESC, symbol LIMIT 20"""))(
    lambda s, sf: ops.recent_bars(ops.ohlcv_bars(_trades(s, sf)), 20, _OHLCV_COLS))

register("buy_pressure", with_trades(f"""
SELECT symbol, window_start, buy_qty, sell_qty,
       (buy_qty / (buy_qty + sell_qty)) * 100 AS buy_pct
FROM ({_BAR_SQL.format(unit='minute')})
WHERE buy_qty + sell_qty > 0
ORDER BY window_start DESC, symbol LIMIT 10"""))(
    lambda s, sf: ops.top_buy_pressure(ops.buy_pressure(ops.ohlcv_bars(_trades(s, sf))), 10))

register("buy_pressure_all", with_trades(f"""
SELECT symbol, window_start, buy_qty, sell_qty,
       (buy_qty / (buy_qty + sell_qty)) * 100 AS buy_pct
FROM ({_BAR_SQL.format(unit='hour')})
WHERE buy_qty + sell_qty > 0"""))(
    lambda s, sf: ops.buy_pressure(ops.ohlcv_bars(_trades(s, sf), "1 hour")))


def _datagen_rows(spark, sf):
    """The generated-rows schema (id, name, amount, event_time) over ``events``."""
    return load_table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("name"),
        F.col("value").alias("amount"), F.col("ts").alias("event_time"))


register("label_rows", """
SELECT event_id AS id, upper(event_type) AS name_upper,
       CAST(round(CAST(value AS DECIMAL(18,2)), 1) AS DOUBLE) AS amount_rounded,
       CASE WHEN value < 33 THEN 'LOW' WHEN value < 66 THEN 'MEDIUM' ELSE 'HIGH' END AS category
FROM events""")(lambda s, sf: ops.label_rows(_datagen_rows(s, sf)))

register("filter_amount", """
SELECT event_id AS id, event_type AS name, value AS amount FROM events WHERE value > 50""")(
    lambda s, sf: ops.filter_amount(_datagen_rows(s, sf), 50))

register("time_slice", with_trades("""
SELECT symbol, ts, price, qty, side, event_time FROM trades
WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_time < TIMESTAMP '2024-01-12 00:00:00'"""))(
    lambda s, sf: _out_trades(ops.time_slice(
        trades_from_events(ops.time_slice(load_table(s, sf, "events"), "2024-01-10 00:00:00", "2024-01-12 00:00:00", "ts")),
        "2024-01-10 00:00:00", "2024-01-12 00:00:00")))

# Unordered LIMIT: which rows is unspecified, so only the row count is checked.
register("peek")(lambda s, sf: _out_trades(ops.peek(_trades(s, sf), 5)))

# ---------------------------------------------------------------- step 3: other windows
register("window_stats", with_trades("""
SELECT symbol, date_trunc('hour', event_time) AS window_start,
       date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
       count(*) AS trade_count,
       CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS total_qty,
       CAST(sum(CAST(price AS DECIMAL(18,4))) AS DOUBLE) / count(price) AS avg_price
FROM trades GROUP BY symbol, date_trunc('hour', event_time)"""))(
    lambda s, sf: ops.window_stats(_trades(s, sf), "1 hour"))

register("window_counts", with_trades("""
SELECT symbol, date_trunc('minute', event_time) AS window_start,
       date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
       count(*) AS trade_count
FROM trades GROUP BY symbol, date_trunc('minute', event_time)"""))(
    lambda s, sf: ops.window_counts(_trades(s, sf), "1 minute"))


def _sliding_sql(k: int, select: str) -> str:
    """Slide 1 minute, size k minutes: each row joins k window starts."""
    return with_trades(f"""
SELECT symbol, window_start, window_start + INTERVAL {k} MINUTE AS window_end, {select}
FROM m GROUP BY symbol, window_start""", f"""m AS (
  SELECT t.*, date_trunc('minute', event_time) - i * INTERVAL 1 MINUTE AS window_start
  FROM trades t CROSS JOIN range({k}) AS u(i)
)""")


register("sliding_counts", _sliding_sql(2, "count(*) AS trade_count"))(
    lambda s, sf: ops.sliding_counts(_trades(s, sf), "2 minutes", "1 minute"))

register("moving_average", _sliding_sql(5, """
CAST(sum(CAST(price AS DECIMAL(18,4))) AS DOUBLE) / count(price) AS avg_price,
count(*) AS trade_count"""))(
    lambda s, sf: ops.moving_average(_trades(s, sf), "5 minutes", "1 minute"))

_SESSIONS_SQL = """
WITH s AS (
  SELECT user_id, ts,
         CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {gap} THEN 1 ELSE 0 END AS new_session
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), g AS (
  SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp
  FROM s
)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {gap} AS session_end,
       count(*) AS event_count
FROM g GROUP BY user_id, grp"""

register("sessions", _SESSIONS_SQL.format(gap="5 MINUTE"))(
    lambda s, sf: ops.sessions(load_table(s, sf, "events"), ["user_id"], "ts", "5 minutes"))

# ---------------------------------------------------------------- step 6: upsert
register("upsert_by_key", """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                           ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) = 1""")(
    lambda s, sf: ops.upsert_by_key(
        load_table(s, sf, "events").withColumn("_ms", F.unix_millis(F.col("ts").cast("timestamp"))),
        ["user_id", "event_type"], "_ms", "event_id").drop("_ms"))

register("upsert_raw_trades", with_trades("""
SELECT symbol, ts, price, qty, side, event_time FROM trades
QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY seq DESC) = 1"""))(
    lambda s, sf: _out_trades(ops.upsert_by_key(_trades(s, sf), ["symbol", "ts"])))

register("upsert_orders_by_customer", """
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")(
    lambda s, sf: ops.upsert_by_key(
        load_table(s, sf, "orders").withColumn("_d", F.unix_micros(F.col("o_orderdate").cast("timestamp"))),
        ["o_custkey"], "_d", "o_orderkey").drop("_d"))



def _merged_table(spark, base_rows, updates, keys, ts, seq, buckets: int = 8) -> DataFrame:
    base = scratch_path(spark, "bucketed")
    old, new = (f"tidemark_{base.rsplit('-', 1)[-1]}_{v}" for v in ("old", "new"))
    buck.create_bucketed(base_rows, old, f"{base}/old", keys, buckets, ts, seq)
    buck.merge_bucketed(spark, old, updates, new, f"{base}/new", keys, buckets, ts, seq)
    return spark.table(new)


def _upsert_trade_id(spark, sf):
    """Trades by id in buckets.  The updates are the later half's trades, corrections of the first half's
    buys, and outdated rows of its sells, which change nothing."""
    t = _trades(spark, sf).select(F.col("seq").alias("trade_id"), "symbol", "price", F.col("qty").alias("quantity"),
                                  F.col("event_time").alias("trade_time"), "side")
    early = F.coalesce(F.col("trade_time") < F.lit(_HALF).cast("timestamp"), F.lit(False))
    first, second = t.where(early), t.where(~early)
    fixed = first.where("side = 'BUY'").withColumn("price", F.col("price") * 2).withColumn("trade_time", F.expr("trade_time + INTERVAL 1 SECOND"))
    stale = first.where("side = 'SELL'").withColumn("price", F.lit(0.0)).withColumn("trade_time", F.expr("trade_time - INTERVAL 1 SECOND"))
    updates = second.unionByName(fixed).unionByName(stale)
    out = _merged_table(spark, first.drop("side"), updates.drop("side"), ["trade_id"], F.unix_micros("trade_time"), F.col("trade_id"))
    return out.withColumn("trade_time", to_ntz("trade_time"))


register("upsert_trade_id", with_trades(f"""
SELECT seq AS trade_id, symbol, CASE WHEN fixed THEN price * 2 ELSE price END AS price, qty AS quantity,
       CASE WHEN fixed THEN event_time + INTERVAL 1 SECOND ELSE event_time END AS trade_time
FROM (SELECT *, side = 'BUY' AND event_time < TIMESTAMP '{_HALF}' AS fixed FROM trades)"""))(_upsert_trade_id)


def _upsert_orders_bucketed(spark, sf):
    """The latest order of each customer, from a bucketed table and the orders that follow it."""
    o = load_table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("date")
    return _merged_table(spark, o.where(early), o.where(~early), ["o_custkey"],
                         F.unix_micros(F.col("o_orderdate").cast("timestamp")), F.col("o_orderkey"))


register("upsert_orders_bucketed", ORACLE["upsert_orders_by_customer"])(_upsert_orders_bucketed)

register("check_unique_key", """
SELECT o_custkey, o_orderdate, count(*) AS row_count FROM orders
GROUP BY o_custkey, o_orderdate HAVING count(*) > 1""")(
    lambda s, sf: ops.check_unique_key(load_table(s, sf, "orders"), ["o_custkey", "o_orderdate"]))

# ---------------------------------------------------------------- step 4: JSON in / out

_PART_SQL = "CAST((('0x' || substr(md5({k}), 1, 8))::BIGINT) % 3 AS INTEGER)"
_VALUE_SQL = "json_object('symbol', symbol, 'ts', ts, 'price', price, 'qty', qty, 'side', side)::VARCHAR"


def _messages(spark, sf):
    return msg.to_messages(_trades(spark, sf), "symbol", 3, "seq")


def _mixed_messages(spark, sf):
    """A feed with two producer faults, derived from every trade:
    'error' trades carry ts as text (wrong type), 'signup' trades are cut
    one character short (malformed JSON).  All others are well formed."""
    t = _trades(spark, sf)
    good = F.to_json(F.struct(*[F.col(c) for c in ("symbol", "ts", "price", "qty", "side")]))
    wrong_ts = F.to_json(F.struct("symbol", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                                  "price", "qty", "side"))
    value = (F.when(F.col("symbol") == "error", wrong_ts)
             .when(F.col("symbol") == "signup", F.expr("substring(to_json(struct(symbol, ts, price, qty, side)), 1, "
                                                     "length(to_json(struct(symbol, ts, price, qty, side))) - 1)"))
             .otherwise(good))
    return t.select(msg.partition_for(F.col("symbol"), 3).alias("partition"),
                    F.col("seq").alias("offset"), F.col("symbol").alias("key"), value.alias("value"))


def _trade_out(df: DataFrame) -> DataFrame:
    return df.select("symbol", "ts", "price", "qty", "side", "seq", to_ntz("event_time").alias("event_time"))


register("write_messages", with_trades(f"""
SELECT {_PART_SQL.format(k='symbol')} AS partition, seq AS offset, symbol AS key, {_VALUE_SQL} AS value
FROM trades"""))(lambda s, sf: _messages(s, sf))

register("message_envelope", with_trades(f"""
SELECT {_PART_SQL.format(k='symbol')} AS partition, seq AS offset, symbol AS key, {_VALUE_SQL} AS value
FROM trades"""))(lambda s, sf: msg.message_envelope(_messages(s, sf)))

register("parse_trades", with_trades("SELECT symbol, ts, price, qty, side, seq, event_time FROM trades"))(
    lambda s, sf: _trade_out(msg.good_trades(msg.parse_trades(_messages(s, sf)))))

register("parse_trades_strict", with_trades("SELECT symbol, ts, price, qty, side, seq, event_time FROM trades"))(
    lambda s, sf: _trade_out(msg.good_trades(
        msg.parse_trades(_messages(s, sf), mode="strict"))))

register("parse_trades_lenient", with_trades("""
SELECT symbol, ts, price, qty, side, seq, event_time FROM trades
WHERE symbol NOT IN ('error', 'signup')"""))(
    lambda s, sf: _trade_out(msg.good_trades(msg.parse_trades(_mixed_messages(s, sf)))))

register("quarantine", with_trades(f"""
SELECT {_PART_SQL.format(k='symbol')} AS partition, seq AS offset, symbol AS key FROM trades
WHERE symbol IN ('error', 'signup')"""))(
    lambda s, sf: msg.quarantine(msg.parse_trades(_mixed_messages(s, sf))).drop("value"))

register("round_trade", with_trades("""
SELECT symbol, ts, round(price, 2) AS price, round(qty, 4) AS qty, side, seq FROM trades"""))(
    lambda s, sf: msg.round_trade(_trades(s, sf)).select("symbol", "ts", "price", "qty", "side", "seq"))

register("clock_label", with_trades("SELECT seq, ts, strftime(event_time, '%H:%M:%S') AS clock FROM trades"))(
    lambda s, sf: _trades(s, sf).select("seq", "ts", clock_label("ts").alias("clock")))

# ---------------------------------------------------------------- step 9: message checks
register("key_partition_counts", with_trades(f"""
SELECT symbol AS key, {_PART_SQL.format(k='symbol')} AS partition, count(*) AS message_count
FROM trades GROUP BY 1, 2"""))(
    lambda s, sf: _messages(s, sf).groupBy("key", "partition").agg(F.count(F.lit(1)).alias("message_count")))

register("key_stays_in_partition", with_trades(f"""
SELECT symbol AS key, count(DISTINCT {_PART_SQL.format(k='symbol')}) AS n_partitions,
       count(DISTINCT {_PART_SQL.format(k='symbol')}) = 1 AS stays
FROM trades GROUP BY 1"""))(
    lambda s, sf: _messages(s, sf).groupBy("key")
    .agg(F.countDistinct("partition").alias("n_partitions"))
    .withColumn("stays", F.col("n_partitions") == 1))

register("topic_non_empty", "SELECT count(*) > 0 AS non_empty FROM (SELECT 1 FROM events LIMIT 1)")(
    lambda s, sf: _messages(s, sf).limit(1).agg((F.count(F.lit(1)) > 0).alias("non_empty")))

# ---------------------------------------------------------------- step 7: versions

# Versions of the events table: one commit per calendar day of ``ts``
# (version = day number since 2023-12-31, so 2024-01-05 is version 5),
# committed at the midnight that ends the day.
_DAY_SQL = "(date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)))"
_COMMITTED_SQL = "(date_trunc('day', ts) + INTERVAL 1 DAY)"
_EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


def _event_versions(spark, sf, name, keyed=True) -> VersionedTable:
    ev = load_table(spark, sf, "events").withColumn("ts_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    vt = VersionedTable(spark, scratch_path(spark, name),
                        keys=["user_id", "event_type"] if keyed else None, ts="ts_ms", seq="event_id")
    vt.bulk_commit(ev, F.datediff(F.to_date("ts"), F.lit("2023-12-31").cast("date")),
                   F.date_trunc("day", F.col("ts").cast("timestamp")) + F.expr("INTERVAL 1 DAY"))
    return vt


def _latest_sql(where: str) -> str:
    return f"""
SELECT {_EVENT_COLS}, epoch_us(ts) // 1000 AS ts_ms FROM events WHERE {where}
QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                           ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) = 1"""


register("append_log", f"SELECT {_EVENT_COLS}, epoch_us(ts) // 1000 AS ts_ms FROM events")(
    lambda s, sf: _event_versions(s, sf, "append_log", keyed=False).snapshot())

register("current_table", _latest_sql("true"))(
    lambda s, sf: _event_versions(s, sf, "current_table").snapshot())

register("version_as_of", _latest_sql(f"{_DAY_SQL} <= 15"))(
    lambda s, sf: _event_versions(s, sf, "version_as_of").snapshot(15))

register("timestamp_as_of", _latest_sql(f"{_COMMITTED_SQL} <= TIMESTAMP '2024-01-20 12:00:00'"))(
    lambda s, sf: _event_versions(s, sf, "timestamp_as_of").as_of_time("2024-01-20 12:00:00"))


def _rolled_back(spark, sf, name):
    vt = _event_versions(spark, sf, name)
    vt.rollback_to(20, committed_at="2024-02-01 00:00:00")
    return vt


register("rollback_to", _latest_sql(f"{_DAY_SQL} <= 20"))(
    lambda s, sf: _rolled_back(s, sf, "rollback_to").snapshot())

_SNAP_SQL = f"""
SELECT {_DAY_SQL} AS version, max({_COMMITTED_SQL}) AS committed_at, 'append' AS operation,
       lag({_DAY_SQL}) OVER (ORDER BY {_DAY_SQL}) AS parent, count(*) AS added_rows
FROM events GROUP BY {_DAY_SQL}"""

register("snapshots", _SNAP_SQL)(lambda s, sf: _event_versions(s, sf, "snapshots").snapshots())

register("history", f"""
WITH c AS ({_SNAP_SQL})
SELECT committed_at AS made_current_at, version, parent, version <= 20 AS is_current_ancestor FROM c
UNION ALL
SELECT TIMESTAMP '2024-02-01 00:00:00', max(version) + 1, max(version), true FROM c""")(
    lambda s, sf: _rolled_back(s, sf, "history").history())

register("manifests")(lambda s, sf: _event_versions(s, sf, "manifests").manifests())
register("files")(lambda s, sf: _event_versions(s, sf, "files").files())

register("rows_growing", f"""
WITH c AS ({_SNAP_SQL})
SELECT version, added_rows,
       CAST(sum(added_rows) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_rows,
       true AS growing
FROM c""")(lambda s, sf: _event_versions(s, sf, "rows_growing").rows_growing())


def _diff(spark, sf):
    d = _event_versions(spark, sf, "snapshot_diff").diff(10, 20)
    return d.select("user_id", "event_type", "change",
                    F.col("_old.event_id").alias("old_event_id"), F.col("_new.event_id").alias("new_event_id"))


register("snapshot_diff", f"""
WITH o AS ({_latest_sql(f"{_DAY_SQL} <= 10")}),
     n AS ({_latest_sql(f"{_DAY_SQL} <= 20")})
SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.event_type, o.event_type) AS event_type,
       CASE WHEN o.event_id IS NULL THEN 'added' WHEN n.event_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
       o.event_id AS old_event_id, n.event_id AS new_event_id
FROM o FULL OUTER JOIN n ON o.user_id = n.user_id AND o.event_type = n.event_type
WHERE o.event_id IS DISTINCT FROM n.event_id""")(_diff)

# ---------------------------------------------------------------- step 8: schema evolution


def _evolving(spark, sf, name):
    ev = load_table(spark, sf, "events")
    vt = VersionedTable(spark, scratch_path(spark, name))
    first = ev.where(F.col("ts") < F.lit(_HALF).cast("timestamp_ntz"))
    second = ev.where(F.col("ts") >= F.lit(_HALF).cast("timestamp_ntz"))
    return vt, first, second


def _add_column(spark, sf):
    vt, a, b = _evolving(spark, sf, "add_column")
    vt.commit(a.select("event_id", "ts", "user_id", "event_type", "value"), "2024-01-16 00:00:00")
    vt.add_column("k", "int", "2024-01-16 00:00:01")
    vt.commit(b.select("event_id", "ts", "user_id", "event_type", "value",
                       F.get_json_object("props", "$.k").cast("int").alias("k")), "2024-01-31 00:00:00")
    return vt.snapshot()


register("add_column", f"""
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN ts < TIMESTAMP '{_HALF}' THEN NULL ELSE CAST(props ->> '$.k' AS INTEGER) END AS k
FROM events""")(_add_column)


def _drop_column(spark, sf):
    vt, a, b = _evolving(spark, sf, "drop_column")
    vt.commit(a, "2024-01-16 00:00:00")
    vt.drop_column("props", "2024-01-16 00:00:01")
    vt.commit(b.drop("props"), "2024-01-31 00:00:00")
    return vt.snapshot()


register("drop_column", "SELECT event_id, ts, user_id, event_type, value FROM events")(_drop_column)


def _rename_column(spark, sf):
    vt, a, b = _evolving(spark, sf, "rename_column")
    vt.commit(a.drop("props"), "2024-01-16 00:00:00")
    vt.rename_column("value", "amount", "2024-01-16 00:00:01")
    vt.commit(b.drop("props").withColumnRenamed("value", "amount"), "2024-01-31 00:00:00")
    return vt.snapshot()


register("rename_column", "SELECT event_id, ts, user_id, event_type, value AS amount FROM events")(_rename_column)


def _reorder_columns(spark, sf):
    vt, a, b = _evolving(spark, sf, "reorder_columns")
    vt.commit(a.drop("props"), "2024-01-16 00:00:00")
    vt.reorder_columns(["event_type", "user_id", "value", "ts", "event_id"], "2024-01-16 00:00:01")
    vt.commit(b.drop("props"), "2024-01-31 00:00:00")
    return vt.snapshot()


register("reorder_columns", "SELECT event_type, user_id, value, ts, event_id FROM events")(_reorder_columns)


def _widen_type(spark, sf):
    vt, a, b = _evolving(spark, sf, "widen_type")
    vt.commit(a.select("event_id", F.col("user_id").cast("int").alias("user_id"), "value"), "2024-01-16 00:00:00")
    vt.widen_type("user_id", "bigint", "2024-01-16 00:00:01")
    vt.commit(b.select("event_id", "user_id", "value"), "2024-01-31 00:00:00")
    return vt.snapshot()


register("widen_type", "SELECT event_id, user_id, value FROM events")(_widen_type)

# ---------------------------------------------------------------- step 8: layouts
_TRANSFORM_SQL = {
    "years": "CAST(year(ts) - 1970 AS INTEGER)",
    "months": "CAST((year(ts) - 1970) * 12 + month(ts) - 1 AS INTEGER)",
    "days": "CAST(ts AS DATE)",
    "hours": "CAST(floor(epoch(ts) / 3600) AS INTEGER)",
}


def _layout_counts(spark, sf, part: lay.Part):
    path = scratch_path(spark, f"partition_{part.transform}")
    lay.write_layout(load_table(spark, sf, "events"), path, [part])
    df = lay.read_layout(spark, path, [part])
    return df.groupBy(F.col(part.name).alias("part")).agg(F.count(F.lit(1)).alias("row_count"))


for _unit, _maker in (("years", lay.years), ("months", lay.months), ("days", lay.days), ("hours", lay.hours)):
    register(f"partition_{_unit}",
             f"SELECT {_TRANSFORM_SQL[_unit]} AS part, count(*) AS row_count FROM events GROUP BY 1")(
        (lambda mk: lambda s, sf: _layout_counts(s, sf, mk("ts")))(_maker))

register("partition_bucket", """
SELECT CAST((('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT) % 16 AS INTEGER) AS part,
       count(*) AS row_count FROM events GROUP BY 1""")(
    lambda s, sf: _layout_counts(s, sf, lay.bucket(16, "user_id")))

register("partition_truncate", """
SELECT substr(event_type, 1, 2) AS part, count(*) AS row_count FROM events GROUP BY 1""")(
    lambda s, sf: _layout_counts(s, sf, lay.truncate(2, "event_type")))

register("partition_truncate_int", """
SELECT user_id - (user_id % 100) AS part, count(*) AS row_count FROM events GROUP BY 1""")(
    lambda s, sf: _layout_counts(s, sf, lay.truncate(100, "user_id")).withColumn("part", F.col("part").cast("long")))

_YMD = [lay.Part("identity", "year", "year"), lay.Part("identity", "month", "month"),
        lay.Part("identity", "day", "day")]


def _partition_slice(spark, sf):
    path = scratch_path(spark, "partition_slice")
    ev = load_table(spark, sf, "events")
    ev = (ev.withColumn("year", F.date_format("ts", "yyyy")).withColumn("month", F.date_format("ts", "MM"))
          .withColumn("day", F.date_format("ts", "dd")))
    ev.write.partitionBy("year", "month", "day").parquet(path)
    # Declared schema: the partition values stay text ('01'), not inferred ints.
    df = spark.read.schema(ev.schema).parquet(path)
    return (df.where((F.col("year") == "2024") & (F.col("month") == "01") & (F.col("day") == "15"))
            .select("event_id", "ts", "user_id", "event_type", "value"))


register("partition_slice", """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE strftime(ts, '%Y') = '2024' AND strftime(ts, '%m') = '01' AND strftime(ts, '%d') = '15'""")(
    _partition_slice)


def _pruned_read(spark, sf):
    path = scratch_path(spark, "pruned_read")
    layout = [lay.days("ts")]
    lay.write_layout(load_table(spark, sf, "events"), path, layout)
    return lay.pruned_read(spark, path, layout, "ts", "2024-01-10 00:00:00", "2024-01-12 00:00:00").drop("ts_day")


register("pruned_read", f"""
SELECT {_EVENT_COLS} FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'""")(_pruned_read)


def _repartition_layout(spark, sf):
    """Days layout for the first half of the month, months layout after it;
    both are read as one table, each pruned by its own derived column."""
    base = scratch_path(spark, "repartition_layout")
    ev = load_table(spark, sf, "events")
    cut = F.lit(_HALF).cast("timestamp_ntz")
    old, new = [lay.days("ts")], [lay.months("ts")]
    lay.write_layout(ev.where(F.col("ts") < cut), f"{base}/layout=1", old)
    lay.write_layout(ev.where(F.col("ts") >= cut), f"{base}/layout=2", new)
    a, b = "2024-01-14 00:00:00", "2024-01-18 00:00:00"
    return lay.union_layouts([
        lay.pruned_read(spark, f"{base}/layout=1", old, "ts", a, b).drop("ts_day"),
        lay.pruned_read(spark, f"{base}/layout=2", new, "ts", a, b).drop("ts_month")])


register("repartition_layout", f"""
SELECT {_EVENT_COLS} FROM events
WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-18 00:00:00'""")(_repartition_layout)

# ---------------------------------------------------------------- step 5: streaming


def _stream_base(spark, sf, name) -> str:
    """Write the trade messages as stream input files."""
    base = scratch_path(spark, name)
    m = _messages(spark, sf)
    sp.write_message_files(m, f"{base}/in")
    return base


def _read_log(spark, path):
    return _trade_out(spark.read.schema(sp.LOG_SCHEMA).parquet(path))


_FINAL_BARS_SQL = with_trades(f"""
SELECT * FROM ({_BAR_SQL.format(unit='minute')})
WHERE window_end <= (SELECT max(event_time) FROM trades) - INTERVAL 5 SECOND""")


def _tumbling_bars_stream(spark, sf):
    base = _stream_base(spark, sf, "tumbling_bars_stream")
    trades = sp.trade_stream(sp.message_stream(spark, f"{base}/in"))
    sp.stream_bars(trades, f"{base}/bars", f"{base}/ckpt", "1 minute", "final")
    return spark.read.parquet(f"{base}/bars")


register("tumbling_bars_stream", _FINAL_BARS_SQL)(_tumbling_bars_stream)


def _upsert_bars_stream(spark, sf):
    base = _stream_base(spark, sf, "upsert_bars_stream")
    trades = sp.trade_stream(sp.message_stream(spark, f"{base}/in"))
    sp.stream_bars(trades, f"{base}/bars", f"{base}/ckpt", "1 minute", "upsert")
    return sp.read_upsert_bars(spark, f"{base}/bars")


register("upsert_bars_stream", with_trades(_BAR_SQL.format(unit="minute")))(_upsert_bars_stream)


def _append_log_stream(spark, sf):
    base = _stream_base(spark, sf, "append_log_stream")
    sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None), f"{base}/log", f"{base}/ckpt")
    return _read_log(spark, f"{base}/log")


_LOG_SQL = with_trades("SELECT symbol, ts, price, qty, side, seq, event_time FROM trades")
register("append_log_stream", _LOG_SQL)(_append_log_stream)


def _replay_stream(spark, sf):
    """Log first: the stored trade log is replayed as a stream into bars."""
    base = _stream_base(spark, sf, "replay_stream")
    sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None), f"{base}/log", f"{base}/ckpt_log")
    sp.stream_bars(sp.log_stream(spark, f"{base}/log"), f"{base}/bars", f"{base}/ckpt_bars", "1 minute", "final")
    return spark.read.parquet(f"{base}/bars")


register("replay_stream", _FINAL_BARS_SQL)(_replay_stream)


def _restart_from_offset(spark, sf):
    """Stop after the first half of the input, add the rest, resume on the same
    checkpoint: every trade lands in the log exactly once."""
    base = scratch_path(spark, "restart_from_offset")
    m = _messages(spark, sf)
    cut = F.unix_millis(F.lit(_HALF).cast("timestamp"))
    jv = F.get_json_object("value", "$.ts").cast("long")
    sp.write_message_files(m.where(jv < cut), f"{base}/in")
    sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None), f"{base}/log", f"{base}/ckpt")
    sp.write_message_files(m.where(jv >= cut), f"{base}/in")
    sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None), f"{base}/log", f"{base}/ckpt")
    return _read_log(spark, f"{base}/log")


register("restart_from_offset", _LOG_SQL)(_restart_from_offset)


def _checkpointed(spark, sf):
    """Rerun on a finished checkpoint with no new input: nothing is written twice."""
    base = _stream_base(spark, sf, "checkpointed")
    for _ in range(2):
        sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None), f"{base}/log", f"{base}/ckpt")
    return _read_log(spark, f"{base}/log")


register("checkpointed", _LOG_SQL)(_checkpointed)


def _fan_out(spark, sf):
    """Two independent readers (own checkpoints) each see every message."""
    base = _stream_base(spark, sf, "fan_out")
    outs = []
    for reader in ("a", "b"):
        sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None),
                      f"{base}/log_{reader}", f"{base}/ckpt_{reader}")
        outs.append(spark.read.schema(sp.LOG_SCHEMA).parquet(f"{base}/log_{reader}")
                    .agg(F.count(F.lit(1)).alias("message_count")).withColumn("reader", F.lit(reader)))
    return outs[0].unionByName(outs[1])


register("fan_out", """
SELECT 'a' AS reader, count(*) AS message_count FROM events
UNION ALL SELECT 'b', count(*) FROM events""")(_fan_out)


def _multi_sink(spark, sf):
    base = _stream_base(spark, sf, "run_multi_sink")
    trades = sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None)
    sp.run_multi_sink(trades, {
        "raw": (lambda d: d.select(*sp.LOG_SCHEMA.fieldNames()), f"{base}/raw"),
        "buys": (lambda d: d.where(F.col("side") == "BUY").select("symbol", "ts", "price", "qty", "seq"),
                 f"{base}/buys"),
    }, f"{base}/ckpt")
    kept = ["symbol", "ts", "price", "qty", "seq"]
    raw = spark.read.parquet(f"{base}/raw").select(F.lit("raw").alias("branch"), *kept)
    return raw.unionByName(spark.read.parquet(f"{base}/buys").select(F.lit("buys").alias("branch"), *kept))


register("run_multi_sink", with_trades("""
SELECT 'raw' AS branch, symbol, ts, price, qty, seq FROM trades
UNION ALL SELECT 'buys', symbol, ts, price, qty, seq FROM trades WHERE side = 'BUY'"""))(_multi_sink)


def _raw_and_bars(spark, sf):
    """One read of the messages fills the trade log, and the log fills the 1-minute
    bars, in micro-batches of bounded size with a restart between the input's halves.
    Returns the rows of both stored tables.  Bars stay open for later rows, so the
    order in which files arrive does not matter."""
    base = scratch_path(spark, "raw_and_bars_stream")
    m = _messages(spark, sf)
    at = F.get_json_object("value", "$.ts").cast("long")
    cut = F.unix_millis(F.lit(_HALF).cast("timestamp"))
    for part in (m.where(at < cut), m.where((at >= cut) | at.isNull())):
        sp.write_message_files(part, f"{base}/in")
        sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{base}/in", max_bytes=sp.MICRO_BATCH_BYTES), None),
                      f"{base}/raw", f"{base}/ckpt_raw")
        sp.stream_bars(sp.log_stream(spark, f"{base}/raw", None, max_bytes=sp.MICRO_BATCH_BYTES), f"{base}/bars",
                       f"{base}/ckpt_bars", "1 minute", "upsert")
    raw = _read_log(spark, f"{base}/raw").select(
        F.lit("raw_trades").alias("target"), "symbol", F.col("event_time").alias("at"), "seq", "price", "qty",
        F.lit(None).cast("long").alias("trade_count"))
    bars = sp.read_upsert_bars(spark, f"{base}/bars").select(
        F.lit("bars_1m").alias("target"), "symbol", F.col("window_start").alias("at"), F.lit(None).cast("long").alias("seq"),
        F.col("close_price").alias("price"), F.col("total_qty").alias("qty"), "trade_count")
    return raw.unionByName(bars)


register("raw_and_bars_stream", with_trades(f"""
SELECT 'raw_trades' AS target, symbol, event_time AS at, seq, price, qty, CAST(NULL AS BIGINT) AS trade_count FROM trades
UNION ALL
SELECT 'bars_1m', symbol, window_start, CAST(NULL AS BIGINT), close_price, total_qty, trade_count
FROM ({_BAR_SQL.format(unit="minute")})"""))(_raw_and_bars)


def _sessions_stream(spark, sf):
    base = scratch_path(spark, "sessions_stream")
    ev = load_table(spark, sf, "events")
    ev.write.parquet(f"{base}/in")
    stream = (spark.readStream.schema(ev.schema).parquet(f"{base}/in")
              .withColumn("event_time", F.col("ts").cast("timestamp"))
              .withWatermark("event_time", "5 seconds"))
    sp.stream_sessions(stream, ["user_id"], "event_time", f"{base}/out", f"{base}/ckpt", "5 minutes")
    return spark.read.parquet(f"{base}/out")


register("sessions_stream", f"""
SELECT * FROM ({_SESSIONS_SQL.format(gap='5 MINUTE')})
WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 5 SECOND""")(_sessions_stream)



def _sessions_by_panes(spark, sf):
    """Sessions of each event type (five hot keys) and of each user, from a stream in three runs on one checkpoint."""
    base = scratch_path(spark, "sessions_by_panes_stream")
    ev = load_table(spark, sf, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = ev.agg(F.min(at), F.max(at)).first()
    outs = {"user_id": "5 minutes", "event_type": "10 seconds"}
    for k in range(3):
        here = F.floor((at - low) * 3 / (high - low + 1)) == k
        ev.where(here | at.isNull() if k == 2 else here).write.mode("append").parquet(f"{base}/in")
        stream = (spark.readStream.schema(ev.schema).parquet(f"{base}/in")
                  .withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", "5 seconds"))
        for key, gap in outs.items():
            st.stream_sessions_by_panes(stream, [key], "event_time", f"{base}/{key}", f"{base}/ckpt_{key}", gap, sum_cols=("value",))
    parts = [spark.read.option("basePath", f"{base}/{key}").parquet(f"{base}/{key}")
             .select(F.lit(key).alias("by"), F.col(key).cast("string").alias("key"), "session_start", "session_end", "event_count", "value")
             for key in outs]
    return parts[0].unionByName(parts[1])


def _pane_sessions_sql(key: str, gap: str, gap_us: int) -> str:
    return f"""
SELECT '{key}' AS by, CAST({key} AS VARCHAR) AS key, min(ts) AS session_start, max(ts) + INTERVAL {gap} AS session_end,
       count(*) AS event_count, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS value
FROM (SELECT *, sum(new_session) OVER (PARTITION BY {key} ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp
      FROM (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL {gap} THEN 1 ELSE 0 END AS new_session
            FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY {key} ORDER BY ts)))
GROUP BY {key}, grp
HAVING (epoch_us(max(ts)) // {gap_us} + 2) * {gap_us} <= (SELECT epoch_us(max(ts)) // 1000 * 1000 - 5000000 FROM events)"""


register("sessions_by_panes_stream", _pane_sessions_sql("user_id", "5 MINUTE", 300_000_000) + "\nUNION ALL"
         + _pane_sessions_sql("event_type", "10 SECOND", 10_000_000))(_sessions_by_panes)

register("late_rows", with_trades("""
SELECT t.symbol, t.ts, t.price, t.qty, t.side, t.seq, t.event_time
FROM trades t JOIN w ON t.seq // 1000 = w.batch
WHERE date_trunc('minute', t.event_time) + INTERVAL 1 MINUTE <= w.watermark""", """b AS (
  SELECT seq // 1000 AS batch, max(event_time) AS m FROM trades GROUP BY 1
), w AS (
  SELECT batch, max(m) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL 5 SECOND AS watermark FROM b
)"""))(
    lambda s, sf: _trade_out(late.late_rows(
        _trades(s, sf).withColumn("batch", F.floor(F.col("seq") / 1000)), "batch").drop("batch")))

register("with_proc_time")(
    lambda s, sf: _trades(s, sf).withColumn("proc_time", to_ntz(F.current_timestamp()))
    .select("symbol", "ts", "proc_time"))

register("process_time_window")(lambda s, sf: sp.process_time_window(_trades(s, sf)))

# ---------------------------------------------------------------- step 9: checks

register("reconcile_bars", with_trades("""
SELECT symbol, log_count, log_count AS bar_count, log_qty, log_qty AS bar_qty, true AS consistent FROM l""",
                             """l AS (
  SELECT symbol, count(*) AS log_count, CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS log_qty
  FROM trades GROUP BY symbol
)"""))(lambda s, sf: reconcile_bars(_trades(s, sf), ops.ohlcv_bars(_trades(s, sf))))



def _reconcile_stored(spark, sf):
    """The two stored tables of one pipeline: the trade log, and the bars that a stream made of it."""
    base = _stream_base(spark, sf, "reconcile_stored_bars")
    sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None), f"{base}/raw", f"{base}/ckpt_raw")
    sp.stream_bars(sp.log_stream(spark, f"{base}/raw", None), f"{base}/bars", f"{base}/ckpt_bars", "1 minute", "upsert")
    return reconcile_bars(spark.read.schema(sp.LOG_SCHEMA).parquet(f"{base}/raw"), sp.read_upsert_bars(spark, f"{base}/bars"))


register("reconcile_stored_bars", ORACLE["reconcile_bars"])(_reconcile_stored)

register("running_summary", with_trades("""
SELECT symbol, min(event_time) AS session_start, max(event_time) + INTERVAL 24 HOUR AS session_end,
       count(*) AS event_count, CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS qty
FROM g GROUP BY symbol, grp""", """s AS (
  SELECT symbol, event_time, qty,
         CASE WHEN lag(event_time) OVER w IS NULL OR event_time - lag(event_time) OVER w > INTERVAL 24 HOUR
              THEN 1 ELSE 0 END AS new_state
  FROM trades WINDOW w AS (PARTITION BY symbol ORDER BY event_time)
), g AS (
  SELECT *, sum(new_state) OVER (PARTITION BY symbol ORDER BY event_time
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM s
)"""))(
    lambda s, sf: ops.sessions(_trades(s, sf), ["symbol"], "event_time", "24 hours", ("qty",), "1 day"))


# ---------------------------------------------------------------- streams with state
def _in_parts(spark, sf, base, start, parts: int = 3) -> list:
    """Messages arrive in ``parts`` stretches of event time, the query restarting on its checkpoint for each; NULL times come last."""
    at = F.get_json_object("value", "$.ts").cast("long")
    m = _messages(spark, sf)
    low, high = m.agg(F.min(at), F.max(at)).first()
    runs = []
    for k in range(parts):
        here = F.floor((at - low) * parts / (high - low + 1)) == k
        sp.write_message_files(m.where(here | at.isNull() if k == parts - 1 else here), f"{base}/in")
        runs.append(start(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None)))
    return runs


def _running_totals(spark, sf):
    """Totals kept in state over three runs of the query; the last one of each symbol."""
    base = scratch_path(spark, "running_totals_stream")
    _in_parts(spark, sf, base, lambda t: st.stream_running_totals(t, f"{base}/out", f"{base}/ckpt", "24 hours"))
    return st.read_running_totals(spark, f"{base}/out")


register("running_totals_stream", with_trades("""
SELECT symbol, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS event_count, CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS qty
FROM trades GROUP BY symbol"""))(_running_totals)


def _reordered(spark, sf):
    """Rows of a symbol released in order and numbered, from messages that arrive shuffled within each run."""
    base = scratch_path(spark, "order_within_key_stream")
    _in_parts(spark, sf, base, lambda t: st.stream_reordered(t, f"{base}/out", f"{base}/ckpt"))
    return spark.read.schema(st.RELEASED).parquet(f"{base}/out/batch_id=*")


register("order_within_key_stream", with_trades("""
SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY ts, seq) AS n, ts, seq, price, qty FROM trades
QUALIFY ts <= (SELECT max(ts) FROM trades) - 5000"""))(_reordered)


def _process_time_stream(spark, sf):
    """Processing-time windows over three runs; whatever the clock said, every trade is in one window."""
    base = scratch_path(spark, "process_time_stream")
    _in_parts(spark, sf, base, lambda t: st.stream_process_time_windows(t, f"{base}/out", f"{base}/ckpt", "2 seconds"))
    windows = st.read_process_time_windows(spark, f"{base}/out")
    return windows.groupBy("symbol").agg(F.sum("trade_count").alias("trade_count"), (F.count("*") > 0).alias("in_windows"))


register("process_time_stream", with_trades("SELECT symbol, count(*) AS trade_count, true AS in_windows FROM trades GROUP BY symbol"))(_process_time_stream)


def _sliding_stream(spark, sf):
    base = scratch_path(spark, "sliding_counts_stream")
    _in_parts(spark, sf, base, lambda t: st.stream_sliding(t.withWatermark("event_time", "5 seconds"), f"{base}/out", f"{base}/ckpt", "2 minutes", "1 minute"))
    return spark.read.parquet(f"{base}/out")


register("sliding_counts_stream", with_trades("""
SELECT symbol, window_start, window_start + INTERVAL 2 MINUTE AS window_end, count(*) AS trade_count,
       CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS total_qty
FROM (SELECT symbol, qty, unnest([date_trunc('minute', event_time), date_trunc('minute', event_time) - INTERVAL 1 MINUTE]) AS window_start FROM trades)
GROUP BY symbol, window_start
HAVING window_start + INTERVAL 2 MINUTE <= (SELECT max(event_time) FROM trades) - INTERVAL 5 SECOND"""))(_sliding_stream)


def _keyed_raw_stream(spark, sf):
    """The keyed raw table, the whole input sent a second time."""
    base = scratch_path(spark, "keyed_raw_stream")
    start = lambda t: st.stream_keyed_raw(t, ["symbol", "ts", "seq"], f"{base}/raw", f"{base}/ckpt")
    _in_parts(spark, sf, base, start)
    sp.write_message_files(_messages(spark, sf), f"{base}/in")
    start(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None))
    return _read_log(spark, f"{base}/raw")


register("keyed_raw_stream", _LOG_SQL)(_keyed_raw_stream)


def _observed_growth(spark, sf):
    """Rows per micro-batch observed while the log is written, no second scan."""
    base = scratch_path(spark, "rows_growing_stream")
    runs = _in_parts(spark, sf, base, lambda t: sp.append_log(st.observe_rows(t), f"{base}/log", f"{base}/ckpt"))
    return st.observed_growth(spark, runs)


register("rows_growing_stream", with_trades("""
SELECT p AS batch_id, count(*) AS rows, sum(count(*)) OVER (ORDER BY p)::BIGINT AS total, true AS growing
FROM (SELECT (ts - (SELECT min(ts) FROM trades)) * 3 // ((SELECT max(ts) - min(ts) FROM trades) + 1) AS p FROM trades) GROUP BY p"""))(_observed_growth)


def _listed_table(spark, sf):
    vt = _event_versions(spark, sf, "list_objects")
    return list_objects(spark, vt.root)


register("list_objects")(lambda s, sf: _listed_table(s, sf).select("path", "length"))

register("table_has_files", "SELECT count(*) > 0 AS has_files FROM (SELECT 1 FROM events LIMIT 1)")(
    lambda s, sf: table_has_files(_listed_table(s, sf)))

# ---------------------------------------------------------------- ordering, watermark, SQL path
register("order_within_key", with_trades(f"""
SELECT partition, key, count(*) AS message_count,
       count(*) FILTER (WHERE ts < prev_max) AS out_of_order
FROM (SELECT {_PART_SQL.format(k='symbol')} AS partition, symbol AS key, seq, ts,
             max(ts) OVER (PARTITION BY symbol ORDER BY seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
      FROM trades)
GROUP BY partition, key"""))(
    lambda s, sf: late.out_of_order(
        _messages(s, sf).withColumn("ts", F.get_json_object("value", "$.ts").cast("long"))))

register("with_watermark", with_trades("""
SELECT batch, max(m) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              - INTERVAL 5 SECOND AS watermark
FROM (SELECT seq // 1000 AS batch, max(event_time) AS m FROM trades GROUP BY 1)"""))(
    lambda s, sf: late.watermarks(_trades(s, sf).withColumn("batch", F.floor(F.col("seq") / 1000)), "batch")
    .withColumn("watermark", to_ntz("watermark")))


def _sql_view(spark, sf):
    project_trades(_trades(spark, sf)).createOrReplaceTempView("raw_trades")


def _sql_symbol_summary(spark, sf):
    _sql_view(spark, sf)
    return spark.sql("""
        SELECT symbol, count(*) AS trade_count,
               CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS total_volume,
               CAST(sum(CAST(price AS DECIMAL(18,4))) AS DOUBLE) / count(price) AS avg_price
        FROM raw_trades GROUP BY symbol""")


register("sql_symbol_summary", ORACLE["symbol_summary"])(_sql_symbol_summary)


def _sql_window_counts(spark, sf):
    _sql_view(spark, sf)
    return spark.sql("""
        SELECT symbol, CAST(window.start AS TIMESTAMP_NTZ) AS window_start,
               CAST(window.end AS TIMESTAMP_NTZ) AS window_end, count(*) AS trade_count
        FROM raw_trades GROUP BY symbol, window(event_time, '1 minute')""")


register("sql_window_counts", ORACLE["window_counts"])(_sql_window_counts)


def _peek_stream(spark, sf):
    """LIMIT on a stream (append mode), collected by the memory sink."""
    base = _stream_base(spark, sf, "peek_stream")
    name = "peek_" + base.rsplit("-", 1)[-1]
    stream = sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None).limit(5)
    sp.run(stream.select("symbol", "ts", "price", "qty", "side").writeStream.format("memory")
           .queryName(name).option("checkpointLocation", f"{base}/ckpt").outputMode("append"))
    return spark.table(name)


register("peek_stream")(_peek_stream)

# ---------------------------------------------------------------- DDL: catalog tables


def _catalog_bars(spark, sf):
    """CREATE DATABASE / CREATE TABLE IF NOT EXISTS / INSERT INTO / read by name."""
    base = scratch_path(spark, "catalog")
    db = "tidemark_" + base.rsplit("-", 1)[-1]
    current = spark.catalog.currentDatabase()
    cat.ensure_database(spark, db, f"{base}/db")
    try:
        cat.create_table_if_missing(spark, f"{db}.raw_trades", cat.RAW_TRADES_SCHEMA, f"{base}/raw_trades")
        cat.create_table_if_missing(spark, f"{db}.agg_1m", cat.AGG_1M_SCHEMA, f"{base}/agg_1m")
        trades = _trades(spark, sf)
        cat.insert(project_trades(trades), f"{db}.raw_trades", cat.RAW_TRADES_SCHEMA)
        cat.insert(ops.ohlcv_bars(trades), f"{db}.agg_1m", cat.AGG_1M_SCHEMA)  # bars from the input, not the table
    finally:
        spark.catalog.setCurrentDatabase(current)
    return spark.table(f"{db}.agg_1m")


register("catalog_tables", ORACLE["ohlcv_bars_1m"])(_catalog_bars)


def _versioned_stream(spark, sf):
    """Stream -> versioned raw-trade table keyed by (symbol, ts), two runs."""
    base = scratch_path(spark, "versioned_stream")
    m = _messages(spark, sf)
    cut = F.unix_millis(F.lit(_HALF).cast("timestamp"))
    jv = F.get_json_object("value", "$.ts").cast("long")
    vt = VersionedTable(spark, f"{base}/table", keys=["symbol", "ts"], ts="ts", seq="seq")
    for part in (m.where(jv < cut), m.where(jv >= cut)):
        sp.write_message_files(part, f"{base}/in")
        sp.stream_to_versioned(sp.trade_stream(sp.message_stream(spark, f"{base}/in"), None),
                               vt, f"{base}/ckpt", "raw_trades")
    return _out_trades(vt.refresh().snapshot())


register("versioned_stream", ORACLE["upsert_raw_trades"])(_versioned_stream)


# Orders arrive by o_orderkey, which is unrelated to o_orderdate: the same
# lateness and ordering checks on a feed whose arrival order is not time order.
def _orders_feed(spark, sf):
    return (load_table(spark, sf, "orders")
            .withColumn("event_time", F.col("o_orderdate").cast("timestamp"))
            .withColumn("batch", F.floor(F.col("o_orderkey") / 1000)))


register("late_rows_orders", """
WITH b AS (SELECT o_orderkey // 1000 AS batch, max(o_orderdate) AS m FROM orders GROUP BY 1),
w AS (SELECT batch, max(m) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    - INTERVAL 1 DAY AS watermark FROM b)
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, w.batch
FROM orders o JOIN w ON o.o_orderkey // 1000 = w.batch
WHERE date_trunc('day', o.o_orderdate) + INTERVAL 1 DAY <= w.watermark""")(
    lambda s, sf: late.late_rows(_orders_feed(s, sf), "batch", "1 day", "1 day")
    .select("o_orderkey", "o_custkey", "o_orderdate", "batch"))

register("order_within_key_orders", """
SELECT o_custkey, count(*) AS message_count, count(*) FILTER (WHERE o_orderdate < prev_max) AS out_of_order
FROM (SELECT o_custkey, o_orderdate,
             max(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
      FROM orders)
GROUP BY o_custkey""")(
    lambda s, sf: late.out_of_order(load_table(s, sf, "orders"), ("o_custkey",), "o_orderkey", "o_orderdate"))


def _compacted(spark, sf):
    vt = _event_versions(spark, sf, "compact_table")
    vt.compact("2024-02-01 00:00:00")
    return vt.snapshot()


register("compact_table", _latest_sql("true"))(_compacted)


# ---------------------------------------------------------------- hot keys on the real data
# Five symbols carry all trades (about 20% each): every key is a hot key.
register("latest_trade_per_symbol", with_trades("""
SELECT symbol, ts, price, qty, side, event_time FROM trades
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) = 1"""))(
    lambda s, sf: _out_trades(ops.upsert_by_key(_trades(s, sf), ["symbol"])))

register("symbol_sessions", with_trades("""
SELECT symbol, min(event_time) AS session_start, max(event_time) + INTERVAL 1 MINUTE AS session_end,
       count(*) AS event_count, CAST(sum(CAST(qty AS DECIMAL(18,4))) AS DOUBLE) AS qty
FROM g GROUP BY symbol, grp""", """s AS (
  SELECT symbol, event_time, qty,
         CASE WHEN lag(event_time) OVER w IS NULL OR event_time - lag(event_time) OVER w > INTERVAL 1 MINUTE
              THEN 1 ELSE 0 END AS new_session
  FROM trades WINDOW w AS (PARTITION BY symbol ORDER BY event_time)
), g AS (
  SELECT *, sum(new_session) OVER (PARTITION BY symbol ORDER BY event_time
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM s
)"""))(
    lambda s, sf: ops.sessions(_trades(s, sf), ["symbol"], "event_time", "1 minute", ("qty",), "1 hour"))
