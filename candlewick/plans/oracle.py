"""The registered queries in SQL, written from the tables up and independent of the Spark code."""

from candlewick.plans.registry import (
    BACKTEST_DAYS, BACKTEST_SYMBOLS, BARS_NOW, HEALTH_NOW, HEALTH_WEEK_NOW, SERVING_NOW, SERVING_SYMBOL, SIGNALS_NOW,
)

_MINUTE = 60_000
_HOUR = 60 * _MINUTE
_DAY = 24 * _HOUR


def _half_up(value: str, digits: int) -> str:
    """Round half up on the decimal form of a double, as Spark does."""
    return f"CAST(round(CAST(CAST(({value}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _sum_half_up(value: str, digits: int) -> str:
    """The same for a value from adding doubles, as far as its first 14 digits: beyond, the order of addition shows."""
    return _half_up(f"CAST(printf('%.13e', {value}) AS DOUBLE)", digits)


def _time(epoch_ms: str) -> str:
    return f"make_timestamp(({epoch_ms}) * 1000)"


def _day_path(epoch_ms: str) -> str:
    return f"strftime({_time(epoch_ms)}, '%Y/%m/%d')"


_TICKS = f"""
ticks AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, event_id AS trade_no, upper(event_type) AS symbol, value AS price,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS quantity,
         user_id % 2 = 0 AS is_buyer_maker,
         epoch_us(ts) // 1000 AS trade_time_ms, epoch_us(ts) // 1000 AS event_time_ms,
         epoch_us(ts) // 1000 + event_id * 37 % 500 AS ingest_time_ms
  FROM events
)"""

_TRADE_COLUMNS = (
    "trade_id, symbol, price, quantity, is_buyer_maker, trade_time_ms, event_time_ms, ingest_time_ms, "
    "notional_usd, latency_ms, date_partition"
)


def _trades_of(source: str, condition: str) -> str:
    return f"""
trades AS (
  SELECT *, {_half_up("price * quantity", 4)} AS notional_usd,
         ingest_time_ms - trade_time_ms AS latency_ms,
         {_day_path("ingest_time_ms")} AS date_partition,
         {_time("trade_time_ms")} AS trade_timestamp
  FROM {source} WHERE {condition}
)"""


_TRADES = _TICKS + "," + _trades_of("ticks", "price > 0 AND quantity > 0")

_LINE_ITEM_TRADES = f"""
ticks AS (
  SELECT CAST((l_orderkey * 8 + l_linenumber) * 10000000 + l_partkey AS VARCHAR) AS trade_id,
         (l_orderkey * 8 + l_linenumber) * 10000000 + l_partkey AS trade_no,
         l_linestatus AS symbol, l_extendedprice AS price, l_quantity AS quantity,
         l_linenumber % 2 = 0 AS is_buyer_maker,
         epoch_us(l_shipdate) // 1000 AS trade_time_ms, epoch_us(l_shipdate) // 1000 AS event_time_ms,
         epoch_us(l_shipdate) // 1000 + l_orderkey % 500 AS ingest_time_ms
  FROM lineitem
),{_trades_of("ticks", "true")}"""

# The faulty feed: which messages are broken, and how, follows from the event id alone.
_FAULTY = f"""
marked AS (
  SELECT event_id % 101 AS fault, event_id, event_type, value, user_id % 2 = 0 AS maker,
         regexp_extract(props, '"k": *([0-9]+)', 1) AS k,
         epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000 + event_id * 37 % 500 AS ingest_time_ms
  FROM events
),
spelled AS (
  SELECT *,
         CASE fault WHEN 2 THEN '"abc"' WHEN 3 THEN 'null' WHEN 4 THEN '"nan"' WHEN 5 THEN '" 1e1 "'
                    WHEN 6 THEN '"1_0"' ELSE '"' || CAST(value AS VARCHAR) || '"' END AS p,
         CASE fault WHEN 7 THEN '"-1"' WHEN 8 THEN '2' ELSE '"' || k || '"' END AS q,
         CASE fault WHEN 9 THEN 'null' ELSE CAST(event_id AS VARCHAR) END AS t,
         CASE fault WHEN 10 THEN '"soon"' ELSE CAST(ms AS VARCHAR) END AS tt,
         CASE fault WHEN 11 THEN 'null' WHEN 12 THEN '"false"' ELSE CAST(maker AS VARCHAR) END AS m,
         CASE WHEN fault IN (5, 6) THEN 10.0 ELSE value END AS price,
         CASE fault WHEN 7 THEN -1.0 WHEN 8 THEN 2.0 ELSE CAST(k AS DOUBLE) END AS quantity,
         CASE WHEN fault IN (11, 12) THEN false ELSE maker END AS is_buyer_maker
  FROM marked
),
bodies AS (
  SELECT *, '{{"e":"trade","E":' || ms || ',"s":"' || event_type || '","t":' || t || ',"p":' || p
            || ',"q":' || q || ',"T":' || tt AS body
  FROM spelled
),
checked AS (
  SELECT *,
         CASE fault WHEN 0 THEN body WHEN 1 THEN body || '}}'
                    WHEN 13 THEN body || ',"m":' || m || '}} x'
                    WHEN 14 THEN '[' || body || ',"m":' || m || '}}]'
                    ELSE body || ',"m":' || m || '}}' END AS raw_message,
         CASE WHEN fault IN (0, 13, 14) THEN 'JSON parse error'
              WHEN fault = 1 THEN 'Missing required fields: [''m'']'
              WHEN fault = 2 THEN 'Type cast error: p=abc'
              WHEN fault = 3 THEN 'Type cast error: p=null'
              WHEN fault = 4 THEN 'Non-finite values: price=NaN, qty=' || CAST(quantity AS VARCHAR)
              WHEN price <= 0 OR quantity <= 0
                THEN 'Non-positive values: price=' || CAST(price AS VARCHAR) || ', qty=' || CAST(quantity AS VARCHAR)
              WHEN fault = 9 THEN 'Null key field: t'
              WHEN fault = 10 THEN 'Type cast error: T=soon' END AS error_reason,
         CAST(event_id AS VARCHAR) AS trade_id, upper(event_type) AS symbol,
         ms AS trade_time_ms, ms AS event_time_ms
  FROM bodies
)"""

_FAULTY_TRADES = _FAULTY + "," + _trades_of("checked", "error_reason IS NULL")

_DEAD_LETTERS = "SELECT raw_message, error_reason, ingest_time_ms AS received_at FROM checked WHERE error_reason IS NOT NULL"


def _bars(width_ms: int, mean: str, starts: str = "") -> str:
    """Bars as a SELECT; `starts` replaces the tumbling window start."""
    start = starts or f"trade_time_ms - trade_time_ms % {width_ms}"
    return f"""
SELECT symbol, CAST({_time("start_ms")} AS DATE) AS date_bucket,
       {_time("start_ms")} AS window_start, {_time(f"start_ms + {width_ms}")} AS window_end,
       arg_min(price, (trade_time_ms, trade_no)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (trade_time_ms, trade_no)) AS close,
       {_sum_half_up("avg(price)", 2)} AS {mean},
       {_sum_half_up("sum(price * quantity) / nullif(sum(quantity), 0)", 2)} AS vwap,
       {_sum_half_up("sum(quantity)", 6)} AS total_volume,
       {_sum_half_up("sum(notional_usd)", 2)} AS total_notional_usd,
       count(*) AS trade_count,
       {_half_up("avg(latency_ms)", 1)} AS avg_latency_ms
FROM (SELECT *, {start} AS start_ms FROM trades) GROUP BY symbol, start_ms"""


def _signals(width_ms: int, label: str, seen: str = "") -> str:
    """CTEs ending in `signals`; `seen` is one more column to group by, with a comma behind."""
    shown = (
        "CASE WHEN price_deviation_pct > 0 AND price_deviation_pct < 0.001 "
        "THEN CAST(round(price_deviation_pct * 10000) AS INT) || '.0E-4' "
        "ELSE CAST(price_deviation_pct AS VARCHAR) END"
    )
    return f"""
sides AS (
  SELECT {seen} symbol, CAST({_time("start_ms")} AS DATE) AS date_bucket, {_time("start_ms")} AS window_start,
         arg_max(price, (trade_time_ms, trade_no)) AS close, avg(price) AS mean, sum(quantity) AS volume,
         sum(CASE WHEN NOT is_buyer_maker THEN quantity ELSE 0 END) AS buy_volume,
         sum(CASE WHEN is_buyer_maker THEN quantity ELSE 0 END) AS sell_volume,
         count(*) AS trade_count
  FROM (SELECT *, trade_time_ms - trade_time_ms % {width_ms} AS start_ms FROM trades)
  GROUP BY {seen} symbol, start_ms
),
measured AS (
  SELECT *, sell_volume > buy_volume * 1.5 AS volume_spike,
         {_sum_half_up("abs(close - mean) / nullif(mean, 0) * 100", 4)} AS price_deviation_pct,
         {_sum_half_up("buy_volume / nullif(buy_volume + sell_volume, 0)", 4)} AS buy_pressure
  FROM sides
),
graded AS (
  SELECT *, CASE WHEN volume_spike AND price_deviation_pct > 2 THEN 'CRITICAL'
                 WHEN volume_spike OR price_deviation_pct > 2 THEN 'HIGH'
                 WHEN price_deviation_pct > 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM measured
),
signals AS (
  SELECT {seen} symbol, date_bucket, window_start, close, {_half_up("mean", 9)} AS sma_{label},
         {_half_up("volume", 9)} AS volume_{label}, buy_volume, sell_volume, trade_count, volume_spike,
         price_deviation_pct, buy_pressure, risk_level,
         CASE risk_level
           WHEN 'CRITICAL' THEN '⚠️ CRITICAL RISK | Price dev: ' || {shown} || '% | Volume dump detected'
           WHEN 'HIGH' THEN '🔴 HIGH risk - Monitor closely. Deviation: ' || {shown} || '%' END AS alert_message
  FROM graded
)"""


_QUARTER = _signals(15 * _MINUTE, "15min")
_FIVE = _bars(5 * _MINUTE, "sma_5min")
_SLIDES = (
    f"unnest([trade_time_ms - trade_time_ms % {_MINUTE} - i * {_MINUTE} for i in range(5)])"
)
_ALERTS = """
SELECT symbol, risk_level, window_start + INTERVAL 15 MINUTES AS alert_time, window_start, close AS price,
       volume_15min AS volume, price_deviation_pct AS deviation_pct, buy_pressure, alert_message, false AS notified
FROM signals WHERE risk_level IN ('HIGH', 'CRITICAL')"""
_HEALTH = f"""
SELECT 'producer' AS component, {_time(f"start_ms + {_MINUTE}")} AS metric_time,
       {_half_up("count(*) / 60.0", 4)} AS messages_per_sec,
       {_half_up("count(error_reason) / CAST(count(*) AS DOUBLE)", 4)} AS error_rate,
       {_half_up("avg(CASE WHEN error_reason IS NULL THEN ingest_time_ms - trade_time_ms END)", 1)} AS avg_latency_ms,
       '{{"accepted":' || (count(*) - count(error_reason)) || ',"dead_letters":' || count(error_reason) || '}}' AS extra_json
FROM (SELECT *, ingest_time_ms - ingest_time_ms % {_MINUTE} AS start_ms FROM checked) GROUP BY start_ms"""
_BAR_COLUMNS = "window_start, open, high, low, close, sma_5min, vwap, total_volume"


# A replay: six deliveries of equal time, some events one later, some three later and then too late for any window.
_DELIVERED = f"""
span AS (
  SELECT min(epoch_us(ts) // 1000) AS lo, (max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000)) // 6 + 1 AS width FROM events
),
parts AS (
  SELECT event_id, (epoch_us(ts) // 1000 - lo) // width AS part, (epoch_us(ts) // 1000 - lo) % width AS into_part, width
  FROM events, span
),
arrivals AS (
  SELECT event_id, event_id % 97 = 5 AND part + 3 < 6 AS late,
         CASE WHEN event_id % 97 = 5 AND part + 3 < 6 THEN part + 3
              WHEN event_id % 2 = 0 AND part + 1 < 6 AND into_part >= width - {5 * _HOUR} THEN part + 1 ELSE part END AS delivery
  FROM parts
)"""
_ON_TIME = (
    f"{_TICKS},{_DELIVERED},{_trades_of('ticks JOIN arrivals ON arrivals.event_id = trade_no', 'price > 0 AND quantity > 0 AND NOT late')}"
)
# Each window as it stood after every delivery that brought it a trade.
_AS_RAISED = f"""{_TICKS},{_DELIVERED},{_trades_of('ticks JOIN arrivals ON arrivals.event_id = trade_no', 'price > 0 AND quantity > 0 AND NOT late')
    .replace("trades AS", "arrived AS", 1)},
touched AS (SELECT DISTINCT symbol, trade_time_ms // {15 * _MINUTE} AS quarter, delivery AS seen FROM arrived),
trades AS (
  SELECT a.*, t.seen FROM arrived a
  JOIN touched t ON a.symbol = t.symbol AND a.trade_time_ms // {15 * _MINUTE} = t.quarter AND a.delivery <= t.seen
)"""


def _rsi(width_ms: int, condition: str = "true") -> str:
    return f"""
bars AS (SELECT * FROM ({_bars(width_ms, "mean")}) WHERE {condition}),
moves AS (
  SELECT symbol, window_start, close, close - lag(close) OVER (PARTITION BY symbol ORDER BY window_start) AS change
  FROM bars
),
means AS (
  SELECT symbol, window_start, close, count(change) OVER recent AS changes,
         avg(CASE WHEN change > 0 THEN change ELSE 0 END) OVER recent AS gain,
         avg(CASE WHEN change < 0 THEN -change ELSE 0 END) OVER recent AS loss
  FROM moves WINDOW recent AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
)
SELECT symbol, window_start, close,
       CASE WHEN changes = 14 THEN
         CASE WHEN loss = 0 THEN 100.0 ELSE {_half_up("100 - 100 / (1 + gain / nullif(loss, 0))", 4)} END END AS rsi_14
FROM means"""


def oracle() -> dict[str, str]:
    plain = f"WITH {_TRADES}"
    faulty = f"WITH {_FAULTY}"
    quarter = f"{plain}, {_QUARTER}"
    signals = f"{quarter} SELECT * FROM signals"
    alerts = f"{quarter} {_ALERTS}"
    trades = f"{plain} SELECT {_TRADE_COLUMNS}, trade_timestamp FROM trades"
    stored = f"{plain} SELECT {_TRADE_COLUMNS} FROM trades"
    five = f"{plain} {_FIVE}"
    trade_json = (
        """'{"trade_id":"' || trade_id || '","symbol":"' || symbol || '","price":' || price || ',"quantity":' """
        """|| quantity || ',"is_buyer_maker":' || is_buyer_maker || ',"trade_time_ms":' || trade_time_ms """
        """|| ',"event_time_ms":' || event_time_ms || ',"ingest_time_ms":' || ingest_time_ms """
        """|| ',"notional_usd":' || notional_usd || ',"latency_ms":' || latency_ms """
        """|| ',"date_partition":"' || date_partition || '"}'"""
    )
    dead_json = (
        """'{"raw_message":"' || replace(replace(raw_message, '\\', '\\\\'), '"', '\\"') """
        """|| '","error_reason":"' || error_reason || '","received_at":' || received_at || '}'"""
    )
    topics = f"""
WITH {_FAULTY_TRADES}, dead AS ({_DEAD_LETTERS}),
messages AS (
  SELECT 'trades' AS topic, trade_id AS key, {trade_json} AS value FROM trades
  UNION ALL SELECT 'trades_dlq', 'dlq', {dead_json} FROM dead
)"""
    chosen = (
        f"price > 0 AND quantity > 0 AND symbol IN {BACKTEST_SYMBOLS} "
        f"AND {_day_path('trade_time_ms')} IN {BACKTEST_DAYS}"
    )
    now = f"TIMESTAMP '{SERVING_NOW}'"
    on_day = f"symbol = '{SERVING_SYMBOL}' AND date_bucket = CAST({now} AS DATE)"
    buckets = [1, 5, 10, 25, 50, 100, 250, 500]
    histogram = " UNION ALL ".join(
        f"SELECT '{bound}' AS le, count(*) FILTER (latency_ms <= {bound}) AS observations FROM trades"
        for bound in buckets
    )
    served = {
        "recent_bars": (
            f"{plain}, bars AS ({_FIVE}) SELECT {_BAR_COLUMNS} FROM bars WHERE {on_day} "
            "ORDER BY window_start DESC LIMIT 288"
        ),
        "last_day_bars": (
            f"{plain}, bars AS ({_FIVE}) SELECT {_BAR_COLUMNS} FROM bars WHERE symbol = '{SERVING_SYMBOL}' "
            f"AND window_start > {now} - INTERVAL 24 HOURS AND window_start <= {now}"
        ),
        "last_day_bars_sliding": (
            f"{plain}, bars AS ({_bars(5 * _MINUTE, 'sma_5min', _SLIDES)}) SELECT {_BAR_COLUMNS} FROM bars "
            f"WHERE symbol = '{SERVING_SYMBOL}' "
            f"AND window_start > {now} - INTERVAL 24 HOURS AND window_start <= {now}"
        ),
        "todays_alerts": (
            f"{quarter} SELECT window_start, risk_level, alert_message, price_deviation_pct, buy_pressure "
            f"FROM signals WHERE {on_day} AND risk_level IN ('HIGH', 'CRITICAL') ORDER BY window_start DESC"
        ),
        "recent_health": (
            f"{faulty}, health AS ({_HEALTH}) SELECT component, metric_time, messages_per_sec, avg_latency_ms "
            f"FROM health WHERE component = 'producer' AND metric_time > TIMESTAMP '{HEALTH_NOW}' - INTERVAL 1 HOUR "
            "ORDER BY metric_time DESC"
        ),
    }
    expired_bars = (
        f"{plain}, bars AS ({_FIVE}) SELECT * FROM bars "
        f"WHERE window_start >= TIMESTAMP '{BARS_NOW}' - INTERVAL 30 DAYS"
    )
    expired_signals = f"{signals} WHERE window_start >= TIMESTAMP '{SIGNALS_NOW}' - INTERVAL 90 DAYS"
    known = "price > 0 AND quantity > 0 AND trade_timestamp < TIMESTAMP '{}'"
    return {
        "trades_valid": trades,
        "trades_valid_faulty_feed": f"WITH {_FAULTY_TRADES} SELECT {_TRADE_COLUMNS} FROM trades",
        "dead_letters": f"{faulty} {_DEAD_LETTERS}",
        "dead_letter_counts": (
            f"{faulty} SELECT split_part(error_reason, ':', 1) AS error_class, count(*) AS dead_letters "
            "FROM checked WHERE error_reason IS NOT NULL GROUP BY 1"
        ),
        "topic_messages": f"{topics} SELECT * FROM messages",
        "message_counts": f"{topics} SELECT topic, count(*) AS messages FROM messages GROUP BY topic",
        "trades_deduplicated": trades,
        "topic_roundtrip": f"WITH {_FAULTY_TRADES} SELECT {_TRADE_COLUMNS}, trade_timestamp FROM trades",
        "bronze_roundtrip": stored,
        "bars_from_bronze": five,
        "backtest_bars": (
            f"WITH {_TICKS},{_trades_of('ticks', chosen)} {_FIVE}"
        ),
        "bars_after_upserts": five,
        "bars_after_rewrite": five,
        "backfill_bars_5min": five,
        "backfill_signals_15min": signals,
        "ohlcv_5min": five,
        "ohlcv_6h": f"{plain} {_bars(6 * _HOUR, 'sma_6h')}",
        "ohlcv_1day": f"{plain} {_bars(_DAY, 'sma_1day')}",
        "ohlcv_sliding_5min_1min": f"{plain} {_bars(5 * _MINUTE, 'sma_5min', _SLIDES)}",
        "ohlcv_1day_hot_symbols": f"WITH {_LINE_ITEM_TRADES} {_bars(_DAY, 'sma_1day')}",
        "rsi_14": f"{plain}, {_rsi(6 * _HOUR)}",
        "rsi_14_hourly": f"{plain}, {_rsi(_HOUR)}",
        "trading_signals_15min": signals,
        "trading_signals_6h": f"{plain}, {_signals(6 * _HOUR, '6h')} SELECT * FROM signals",
        "trading_signals_1day": f"{plain}, {_signals(_DAY, '1day')} SELECT * FROM signals",
        "trading_signals_1day_hot_symbols": (
            f"WITH {_LINE_ITEM_TRADES}, {_signals(_DAY, '1day')} SELECT * FROM signals"
        ),
        "high_risk_signals": f"{signals} WHERE risk_level IN ('HIGH', 'CRITICAL')",
        "high_risk_count": (
            f"{quarter} SELECT count(*) AS signals, "
            "count(*) FILTER (risk_level IN ('HIGH', 'CRITICAL')) AS high_risk FROM signals"
        ),
        "alert_history": alerts,
        "latest_signals": (
            f"{quarter} SELECT symbol, date_bucket, window_start, risk_level, alert_message, close, sma_15min, "
            "buy_pressure, price_deviation_pct, volume_spike FROM signals "
            "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1"
        ),
        "bronze_zones": (
            f"{plain} SELECT date_partition, symbol, min(trade_time_ms) AS first_ms, max(trade_time_ms) AS last_ms, "
            "count(*) AS trades FROM trades GROUP BY date_partition, symbol"
        ),
        "upsert_counts": " UNION ALL ".join(
            f"SELECT * FROM (WITH {_TICKS},{_trades_of('ticks', known.format(moment))}, {_QUARTER} "
            f"SELECT CAST({number} AS BIGINT) AS batch_id, count(*) AS rows, "
            "count(*) FILTER (risk_level IN ('HIGH', 'CRITICAL')) AS high_risk FROM signals)"
            for number, moment in enumerate(("2024-01-10 01:02:00", "2024-01-20 01:02:00", "2024-02-20 00:00:00"))
        ),
        **{f"served_{name}": sql for name, sql in served.items()},
        "served_alert_history": (
            f"{quarter} SELECT * FROM ({_ALERTS}) WHERE CAST(alert_time AS DATE) = DATE '2024-01-15'"
        ),
        **{name: sql for name, sql in served.items()},
        "expired_bars_30d": expired_bars,
        "expired_signals_90d": expired_signals,
        "expired_alerts_90d": (
            f"{quarter} SELECT * FROM ({_ALERTS}) WHERE alert_time >= TIMESTAMP '{SIGNALS_NOW}' - INTERVAL 90 DAYS"
        ),
        "expired_health_7d": (
            f"{faulty} SELECT * FROM ({_HEALTH}) WHERE metric_time >= TIMESTAMP '{HEALTH_WEEK_NOW}' - INTERVAL 7 DAYS"
        ),
        "replay_bronze": stored,
        "replay_bars_5min": f"WITH {_ON_TIME} {_FIVE}",
        "replay_bars_sliding": f"WITH {_ON_TIME} {_bars(5 * _MINUTE, 'sma_5min', _SLIDES)}",
        "replay_signals_15min": f"WITH {_ON_TIME}, {_QUARTER} SELECT * FROM signals",
        "replay_alert_history": (
            f"WITH {_AS_RAISED}, {_signals(15 * _MINUTE, '15min', 'seen,')} "
            f"SELECT * EXCLUDE (seen) FROM ({_ALERTS.replace('SELECT ', 'SELECT seen, ', 1)}) "
            "QUALIFY row_number() OVER (PARTITION BY symbol, risk_level, alert_time ORDER BY seen DESC) = 1"
        ),
        "replay_latest_signals": (
            f"WITH {_ON_TIME}, {_QUARTER} SELECT symbol, date_bucket, window_start, risk_level, alert_message, close, "
            "sma_15min, buy_pressure, price_deviation_pct, volume_spike FROM signals "
            "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1"
        ),
        "replay_rsi_14": (
            f"WITH {_ON_TIME}, known AS (SELECT max(trade_timestamp) AS newest FROM trades), "
            + _rsi(5 * _MINUTE, "window_end <= (SELECT newest FROM known) - INTERVAL 6 HOURS").replace(
                "SELECT symbol, window_start, close,\n", "SELECT symbol, CAST(window_start AS DATE) AS date_bucket, window_start, close,\n"
            )
        ),
        "replay_batches": (
            f"WITH {_DELIVERED} SELECT CAST(delivery AS BIGINT) AS delivery, count(*) AS input_rows FROM arrivals GROUP BY delivery"
        ),
        "retain_bars_30d": expired_bars,
        "retain_signals_90d": expired_signals,
        "component_health": f"{faulty} {_HEALTH}",
        "latency_histogram": f"{plain} {histogram} UNION ALL SELECT '+Inf', count(latency_ms) FROM trades",
        "last_trade": (
            f"{plain} SELECT symbol, arg_max(trade_time_ms, (ingest_time_ms, trade_no)) AS last_trade_time_ms "
            "FROM trades GROUP BY symbol"
        ),
        "stream_bronze": stored,
        "stream_bars_5min": five,
        "stream_bars_sliding": f"{plain} {_bars(5 * _MINUTE, 'sma_5min', _SLIDES)}",
        "stream_bars_deduplicated": five,
        "stream_topic_messages": f"{topics} SELECT * FROM messages",
        "stream_signals_15min": signals,
        "stream_alert_history": alerts,
        "stream_component_health": f"{faulty} {_HEALTH}",
    }
