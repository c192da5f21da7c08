"""Declared schemas of every table the package reads or writes."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_text, _real, _flag, _long = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType()
_time, _day = T.TimestampType(), T.DateType()

TOPIC = _struct(("key", _text), ("value", _text))

TRADE = _struct(
    ("trade_id", _text),
    ("symbol", _text),
    ("price", _real),
    ("quantity", _real),
    ("is_buyer_maker", _flag),
    ("trade_time_ms", _long),
    ("event_time_ms", _long),
    ("ingest_time_ms", _long),
    ("notional_usd", _real),
    ("latency_ms", _long),
    ("date_partition", _text),
)



def _part_of(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([schema[name] for name in names])


# What the windowed jobs read of a trade; a narrow schema spares the JSON parser the other fields.
SILVER_INPUT = _part_of(TRADE, "trade_id", "symbol", "price", "quantity", "trade_time_ms", "notional_usd", "latency_ms")
GOLD_INPUT = _part_of(TRADE, "trade_id", "symbol", "price", "quantity", "is_buyer_maker", "trade_time_ms")

DEAD_LETTER = _struct(("raw_message", _text), ("error_reason", _text), ("received_at", _long))

BAR = _struct(
    ("symbol", _text),
    ("date_bucket", _day),
    ("window_start", _time),
    ("window_end", _time),
    ("open", _real),
    ("high", _real),
    ("low", _real),
    ("close", _real),
    ("sma_5min", _real),
    ("vwap", _real),
    ("total_volume", _real),
    ("total_notional_usd", _real),
    ("trade_count", _long),
    ("avg_latency_ms", _real),
)

SIGNAL = _struct(
    ("symbol", _text),
    ("date_bucket", _day),
    ("window_start", _time),
    ("close", _real),
    ("sma_15min", _real),
    ("volume_15min", _real),
    ("buy_volume", _real),
    ("sell_volume", _real),
    ("trade_count", _long),
    ("volume_spike", _flag),
    ("price_deviation_pct", _real),
    ("buy_pressure", _real),
    ("risk_level", _text),
    ("alert_message", _text),
)

# What a window of trades adds up to; windows of these panes merge into longer or sliding ones.
_place = T.DecimalType(38, 0)
PANE = _struct(
    ("symbol", _text),
    ("date_bucket", _day),
    ("window_start", _time),
    ("window_end", _time),
    ("open", _real),
    ("open_at", _place),
    ("close", _real),
    ("close_at", _place),
    ("high", _real),
    ("low", _real),
    ("price_sum", _real),
    ("price_count", _long),
    ("turnover", _real),
    ("volume", _real),
    ("notional", _real),
    ("latency_sum", _real),
    ("latency_count", _long),
    ("trade_count", _long),
)

CLOSE = _struct(("symbol", _text), ("window_start", _time), ("close", _real))

RSI = _struct(("symbol", _text), ("date_bucket", _day), ("window_start", _time), ("close", _real), ("rsi_14", _real))

LATEST_SIGNAL = _struct(
    ("symbol", _text),
    ("date_bucket", _day),
    ("window_start", _time),
    ("risk_level", _text),
    ("alert_message", _text),
    ("close", _real),
    ("sma_15min", _real),
    ("buy_pressure", _real),
    ("price_deviation_pct", _real),
    ("volume_spike", _flag),
)

ZONE = _struct(("file", _text), ("first_ms", _long), ("last_ms", _long), ("trades", _long))

ALERT = _struct(
    ("symbol", _text),
    ("risk_level", _text),
    ("alert_time", _time),
    ("window_start", _time),
    ("price", _real),
    ("volume", _real),
    ("deviation_pct", _real),
    ("buy_pressure", _real),
    ("alert_message", _text),
    ("notified", _flag),
)

HEALTH = _struct(
    ("component", _text),
    ("metric_time", _time),
    ("messages_per_sec", _real),
    ("error_rate", _real),
    ("avg_latency_ms", _real),
    ("extra_json", _text),
)
