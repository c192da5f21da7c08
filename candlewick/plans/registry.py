"""The registered queries: every operator over the whole of the given tables."""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from candlewick.operators import health, serving, signals as risk, tables
from candlewick.operators.bars import ohlcv
from candlewick.operators.indicators import rsi
from candlewick.operators.ingest import (
    accepted, rejected, topic_rows, with_event_time, without_repeats,
)
from candlewick.operators.summaries import panes, summarise
from candlewick.plans.backfill import backfill
from candlewick.session import scratch_folder, stream_session
from candlewick.settings import BARS_PER_DAY, LATENESS, RETENTION_DAYS, SILVER_SLIDE, TRADES_TOPIC
from candlewick.sinks.bronze import write_bronze
from candlewick.sinks.keyed import alert_table, bar_table, health_table, pane_table, rsi_table, signal_table
from candlewick.sinks.topic import topic_folder, write_checked
from candlewick.sources import samples
from candlewick.sources.bronze import read_bronze, read_days, refresh_zones
from candlewick.sources.topic import decode_trades
from candlewick.streaming.jobs import (
    JobPaths, latest_view, sliding_bars, start_bronze, start_gold, start_health, start_panes, start_rsi, start_silver,
    start_upsert,
)
from candlewick.streaming.progress import batch_counts
from candlewick.streaming.replay import replay

Query = Callable[[SparkSession, str], DataFrame]

# Fixed moments inside the span of the tables, standing for "now".
SERVING_SYMBOL = "CLICK"
SERVING_NOW = "2024-01-15 18:30:00"
BARS_NOW = "2024-02-10 12:00:00"
SIGNALS_NOW = "2024-04-10 12:00:00"
HEALTH_NOW = "2024-01-15 18:30:00"
HEALTH_WEEK_NOW = "2024-01-22 12:00:00"
BACKTEST_DAYS = ("2024/01/09", "2024/01/10")
BACKTEST_SYMBOLS = ("CLICK", "VIEW")
_ONCE = {"availableNow": True}

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return {name: _finished(function) for name, function in _REGISTRY.items()}


def _finished(function: Query) -> Query:
    """Timestamps leave as zone-free UTC, the type the given tables use."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = function(spark, sf_dir)
        return result.select(
            *[
                F.col(item.name).cast("timestamp_ntz").alias(item.name)
                if isinstance(item.dataType, T.TimestampType)
                else F.col(item.name)
                for item in result.schema.fields
            ]
        )

    run.__name__ = function.__name__
    return run


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.trades(samples.events(spark, sf_dir))


def _checked(spark: SparkSession, sf_dir: str, faulty: bool = True) -> DataFrame:
    return samples.checked_messages(samples.events(spark, sf_dir), faulty)


def _steady(rows: DataFrame, *columns: str) -> DataFrame:
    """Round raw means and sums to nine digits: their last bits depend on the order of addition."""
    return rows.withColumns({name: F.round(name, 9) for name in columns})


# -- validation and routing --------------------------------------------------------------------------


@query
def trades_valid(spark, sf_dir):
    return with_event_time(accepted(_checked(spark, sf_dir, faulty=False)))


@query
def trades_valid_faulty_feed(spark, sf_dir):
    return accepted(_checked(spark, sf_dir))


@query
def dead_letters(spark, sf_dir):
    return rejected(_checked(spark, sf_dir))


@query
def dead_letter_counts(spark, sf_dir):
    return health.dead_letter_counts(rejected(_checked(spark, sf_dir)))


@query
def topic_messages(spark, sf_dir):
    return topic_rows(_checked(spark, sf_dir))


@query
def message_counts(spark, sf_dir):
    return health.message_counts(topic_rows(_checked(spark, sf_dir)))


@query
def trades_deduplicated(spark, sf_dir):
    trades = _trades(spark, sf_dir)
    return without_repeats(trades.unionByName(trades))


# -- storage round trips -----------------------------------------------------------------------------


@query
def topic_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark, "topics")
    write_checked(_checked(spark, sf_dir), kind="files", path=folder)
    stored = spark.read.schema("key string, value string").parquet(topic_folder(folder, TRADES_TOPIC))
    return with_event_time(decode_trades(stored))


@query
def bronze_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark, "bronze")
    write_bronze(_trades(spark, sf_dir).drop("trade_timestamp"), folder)
    return read_bronze(spark, folder)


@query
def bars_from_bronze(spark, sf_dir):
    folder = scratch_folder(spark, "bronze")
    write_bronze(_trades(spark, sf_dir).drop("trade_timestamp"), folder)
    return ohlcv(with_event_time(read_bronze(spark, folder)))


@query
def backtest_bars(spark, sf_dir):
    """Bars of two days and two symbols: whole ones, from the files of any ingest day that hold trades of these days."""
    folder = scratch_folder(spark, "bronze")
    write_bronze(_trades(spark, sf_dir).drop("trade_timestamp"), folder)
    return ohlcv(with_event_time(read_days(spark, folder, BACKTEST_DAYS, BACKTEST_SYMBOLS)))


@query
def bronze_zones(spark, sf_dir):
    """The zone map of the stored trades, added up by folder."""
    folder = scratch_folder(spark, "bronze")
    write_bronze(_trades(spark, sf_dir).drop("trade_timestamp"), folder)
    zones = refresh_zones(spark, folder)
    day, symbol = (F.regexp_extract("file", f"{name}=([^/]+)", 1) for name in ("date_partition", "symbol"))
    return zones.groupBy(F.replace(day, F.lit("%2F"), F.lit("/")).alias("date_partition"), symbol.alias("symbol")).agg(
        F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"), F.sum("trades").alias("trades")
    )


@query
def upsert_counts(spark, sf_dir):
    """What three batches of signals report to have written, each of the trades known by then."""
    trades, table, counts = _trades(spark, sf_dir), signal_table(scratch_folder(spark, "signals")), []
    for batch_id, known_to in enumerate(["2024-01-10 01:02:00", "2024-01-20 01:02:00", "2024-02-20 00:00:00"]):
        known = trades.filter(F.col("trade_timestamp") < F.lit(known_to).cast("timestamp"))
        written = table.upsert(risk.trading_signals(known), batch_id)
        counts.append((batch_id, written["rows"], written["high_risk"]))
    return spark.createDataFrame(counts, "batch_id long, rows long, high_risk long")


@query
def bars_after_rewrite(spark, sf_dir):
    """A batch that was folded into the base is written again under its name: the new rows show."""
    trades = _trades(spark, sf_dir)
    table = bar_table(scratch_folder(spark, "bars"))
    table.upsert(ohlcv(trades.filter(F.col("trade_timestamp") < F.lit("2024-01-10 01:02:00").cast("timestamp"))), 0)
    table.compact(spark)
    table.upsert(ohlcv(trades), 0)
    table.compact(spark)
    table.drop_superseded(spark)
    return table.current(spark)


@query
def bars_after_upserts(spark, sf_dir):
    """Three batches, each recomputing the bars of the trades known so far; then a compaction."""
    trades = _trades(spark, sf_dir)
    table = bar_table(scratch_folder(spark, "bars"))
    for batch_id, known_to in enumerate(["2024-01-10 01:02:00", "2024-01-20 01:02:00"]):
        table.upsert(ohlcv(trades.filter(F.col("trade_timestamp") < F.lit(known_to).cast("timestamp"))), batch_id)
    table.compact(spark)
    table.upsert(ohlcv(trades), 2)
    return table.current(spark)


@query
def backfill_bars_5min(spark, sf_dir):
    paths = JobPaths(scratch_folder(spark, "backfill"))
    backfill(_trades(spark, sf_dir), paths)
    return bar_table(paths.bars).current(spark)


@query
def backfill_signals_15min(spark, sf_dir):
    paths = JobPaths(scratch_folder(spark, "backfill"))
    backfill(_trades(spark, sf_dir), paths)
    return _steady(signal_table(paths.signals).current(spark), "sma_15min", "volume_15min")


# -- bars --------------------------------------------------------------------------------------------


@query
def ohlcv_5min(spark, sf_dir):
    return ohlcv(_trades(spark, sf_dir))


@query
def ohlcv_6h(spark, sf_dir):
    return ohlcv(_trades(spark, sf_dir), "6 hours")


@query
def ohlcv_1day(spark, sf_dir):
    return ohlcv(_trades(spark, sf_dir), "1 day")


@query
def ohlcv_sliding_5min_1min(spark, sf_dir):
    return ohlcv(_trades(spark, sf_dir), slide="1 minute")


@query
def ohlcv_1day_hot_symbols(spark, sf_dir):
    return ohlcv(samples.line_item_trades(samples.line_items(spark, sf_dir)), "1 day")


@query
def rsi_14(spark, sf_dir):
    return rsi(ohlcv(_trades(spark, sf_dir), "6 hours"))


@query
def rsi_14_hourly(spark, sf_dir):
    return rsi(ohlcv(_trades(spark, sf_dir), "1 hour"))


# -- signals -----------------------------------------------------------------------------------------


@query
def trading_signals_15min(spark, sf_dir):
    return _steady(risk.trading_signals(_trades(spark, sf_dir)), "sma_15min", "volume_15min")


@query
def trading_signals_6h(spark, sf_dir):
    return _steady(risk.trading_signals(_trades(spark, sf_dir), "6 hours"), "sma_6h", "volume_6h")


@query
def trading_signals_1day(spark, sf_dir):
    return _steady(risk.trading_signals(_trades(spark, sf_dir), "1 day"), "sma_1day", "volume_1day")


@query
def trading_signals_1day_hot_symbols(spark, sf_dir):
    trades = samples.line_item_trades(samples.line_items(spark, sf_dir))
    return _steady(risk.trading_signals(trades, "1 day"), "sma_1day", "volume_1day")


@query
def high_risk_signals(spark, sf_dir):
    return _steady(risk.high_risk(risk.trading_signals(_trades(spark, sf_dir))), "sma_15min", "volume_15min")


@query
def high_risk_count(spark, sf_dir):
    return health.high_risk_count(risk.trading_signals(_trades(spark, sf_dir)))


@query
def alert_history(spark, sf_dir):
    return risk.alert_history(risk.trading_signals(_trades(spark, sf_dir)))


@query
def latest_signals(spark, sf_dir):
    return _steady(tables.latest_signals(risk.trading_signals(_trades(spark, sf_dir))), "sma_15min")


# -- serving and retention ---------------------------------------------------------------------------


@query
def recent_bars(spark, sf_dir):
    return serving.recent_bars(ohlcv(_trades(spark, sf_dir)), SERVING_SYMBOL, SERVING_NOW, BARS_PER_DAY)


@query
def last_day_bars(spark, sf_dir):
    return serving.last_day_bars(ohlcv(_trades(spark, sf_dir)), SERVING_SYMBOL, SERVING_NOW)


@query
def last_day_bars_sliding(spark, sf_dir):
    return serving.last_day_bars(ohlcv(_trades(spark, sf_dir), slide="1 minute"), SERVING_SYMBOL, SERVING_NOW)


@query
def todays_alerts(spark, sf_dir):
    return serving.todays_alerts(risk.trading_signals(_trades(spark, sf_dir)), SERVING_SYMBOL, SERVING_NOW)


@query
def recent_health(spark, sf_dir):
    return serving.recent_health(_health(spark, sf_dir), HEALTH_NOW)


@query
def retain_bars_30d(spark, sf_dir):
    return tables.retain(ohlcv(_trades(spark, sf_dir)), "window_start", RETENTION_DAYS["bars"], BARS_NOW)


@query
def retain_signals_90d(spark, sf_dir):
    signals = risk.trading_signals(_trades(spark, sf_dir))
    kept = tables.retain(signals, "window_start", RETENTION_DAYS["signals"], SIGNALS_NOW)
    return _steady(kept, "sma_15min", "volume_15min")


# -- dashboard reads of stored tables ----------------------------------------------------------------


def _written(table, rows: DataFrame):
    """The rows in a table, in two batches: the first has all of them, the second those of later days once more."""
    table.upsert(rows, 0, "first")
    table.upsert(rows.filter(F.col(table.time_column) >= F.lit("2024-01-12").cast("timestamp")), 1, "second")
    return table


@query
def served_recent_bars(spark, sf_dir):
    table = _written(bar_table(scratch_folder(spark, "bars")), ohlcv(_trades(spark, sf_dir)))
    return serving.recent_bars(table.current(spark), SERVING_SYMBOL, SERVING_NOW)


@query
def served_last_day_bars(spark, sf_dir):
    table = _written(bar_table(scratch_folder(spark, "bars")), ohlcv(_trades(spark, sf_dir)))
    return serving.last_day_bars(table.current(spark), SERVING_SYMBOL, SERVING_NOW)


@query
def served_last_day_bars_sliding(spark, sf_dir):
    """Sliding bars of a day from the panes that touch it."""
    paths = JobPaths(scratch_folder(spark, "live"))
    _written(pane_table(paths.panes), panes(summarise(_trades(spark, sf_dir), SILVER_SLIDE)))
    bars = sliding_bars(spark, paths, since="2024-01-14 18:25:00", until="2024-01-15 18:35:00")
    return serving.last_day_bars(bars, SERVING_SYMBOL, SERVING_NOW)


@query
def served_todays_alerts(spark, sf_dir):
    signals = risk.trading_signals(_trades(spark, sf_dir))
    table = _written(signal_table(scratch_folder(spark, "signals")), signals)
    return serving.todays_alerts(table.current(spark), SERVING_SYMBOL, SERVING_NOW)


@query
def served_alert_history(spark, sf_dir):
    """The alerts of one day, all symbols."""
    alerts = risk.alert_history(risk.trading_signals(_trades(spark, sf_dir)))
    table = _written(alert_table(scratch_folder(spark, "alerts")), alerts)
    return table.current(spark, since="2024-01-15 00:00:00", until="2024-01-15 23:59:59.999999")


@query
def served_recent_health(spark, sf_dir):
    table = _written(health_table(scratch_folder(spark, "health")), _health(spark, sf_dir))
    return serving.recent_health(table.current(spark), HEALTH_NOW)


def _expired(spark: SparkSession, table, rows: DataFrame, days: int, now: str) -> DataFrame:
    _written(table, rows).expire(spark, days, now)
    return table.current(spark)


@query
def expired_bars_30d(spark, sf_dir):
    table = bar_table(scratch_folder(spark, "bars"))
    return _expired(spark, table, ohlcv(_trades(spark, sf_dir)), RETENTION_DAYS["bars"], BARS_NOW)


@query
def expired_signals_90d(spark, sf_dir):
    table, signals = signal_table(scratch_folder(spark, "signals")), risk.trading_signals(_trades(spark, sf_dir))
    return _steady(_expired(spark, table, signals, RETENTION_DAYS["signals"], SIGNALS_NOW), "sma_15min", "volume_15min")


@query
def expired_alerts_90d(spark, sf_dir):
    table = alert_table(scratch_folder(spark, "alerts"))
    alerts = risk.alert_history(risk.trading_signals(_trades(spark, sf_dir)))
    return _expired(spark, table, alerts, RETENTION_DAYS["alerts"], SIGNALS_NOW)


@query
def expired_health_7d(spark, sf_dir):
    table = health_table(scratch_folder(spark, "health"))
    return _expired(spark, table, _health(spark, sf_dir), RETENTION_DAYS["health"], HEALTH_WEEK_NOW)


# -- operations --------------------------------------------------------------------------------------


def _health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.component_health(health.with_ingest_time(_checked(spark, sf_dir)))


@query
def component_health(spark, sf_dir):
    return _health(spark, sf_dir)


@query
def latency_histogram(spark, sf_dir):
    return health.latency_histogram(_trades(spark, sf_dir))


@query
def last_trade(spark, sf_dir):
    return health.last_trade(_trades(spark, sf_dir))


# -- streaming ---------------------------------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str, start) -> JobPaths:
    """Run one live job over the whole table until its end."""
    paths = JobPaths(scratch_folder(spark, "live"))
    trades = samples.trades(samples.events(stream_session(spark), sf_dir, stream=True), lateness=LATENESS)
    start(trades, paths, trigger=_ONCE).awaitTermination()
    return paths


@query
def stream_bronze(spark, sf_dir):
    return read_bronze(spark, _streamed(spark, sf_dir, start_bronze).bronze)


@query
def stream_bars_5min(spark, sf_dir):
    return bar_table(_streamed(spark, sf_dir, start_silver).bars).current(spark)


@query
def stream_bars_sliding(spark, sf_dir):
    def start(trades, paths, trigger):
        bars = ohlcv(trades, slide="1 minute")
        return start_upsert(bars, bar_table(paths.bars), paths.checkpoint("sliding"), trigger)

    return bar_table(_streamed(spark, sf_dir, start).bars).current(spark)


@query
def stream_bars_deduplicated(spark, sf_dir):
    """Every trade is delivered twice and counted once."""
    paths = JobPaths(scratch_folder(spark, "live"))
    source = samples.events(stream_session(spark), sf_dir, stream=True)
    trades = without_repeats(samples.trades(source.unionByName(source), lateness=LATENESS))
    start_silver(trades, paths, trigger=_ONCE).awaitTermination()
    return bar_table(paths.bars).current(spark)


@query
def stream_signals_15min(spark, sf_dir):
    signals = signal_table(_streamed(spark, sf_dir, start_gold).signals).current(spark)
    return _steady(signals, "sma_15min", "volume_15min")


@query
def stream_alert_history(spark, sf_dir):
    paths = _streamed(spark, sf_dir, partial(start_gold, alerts=True))
    return alert_table(paths.alerts).current(spark)


# -- replays: many micro-batches, late rows, restarts ------------------------------------------------

# The job is stopped after the third and the fourth delivery and goes on from its checkpoint.
_SESSIONS = ((0, 1, 2), (3,), (4, 5))


def _replayed(spark: SparkSession, sf_dir: str, start) -> tuple[JobPaths, list[dict]]:
    """Run one live job over the whole table as it would have arrived."""
    folder = scratch_folder(spark, "replay")
    paths = JobPaths(f"{folder}/live")

    def started(events: DataFrame):
        return start(samples.trades(events, lateness=samples.REPLAY_LATENESS), paths, trigger=_ONCE)

    return paths, replay(samples.deliveries(samples.events(spark, sf_dir)), folder, started, _SESSIONS)


@query
def replay_bronze(spark, sf_dir):
    """Every trade, also the ones that come too late for the bars."""
    return read_bronze(spark, _replayed(spark, sf_dir, start_bronze)[0].bronze)


@query
def replay_bars_5min(spark, sf_dir):
    return bar_table(_replayed(spark, sf_dir, start_silver)[0].bars).current(spark)


@query
def replay_bars_sliding(spark, sf_dir):
    """Windows merged from panes when they are read; the job holds one row of state for a symbol and minute."""
    return sliding_bars(spark, _replayed(spark, sf_dir, start_panes)[0])


@query
def replay_signals_15min(spark, sf_dir):
    signals = signal_table(_replayed(spark, sf_dir, start_gold)[0].signals).current(spark)
    return _steady(signals, "sma_15min", "volume_15min")


@query
def replay_alert_history(spark, sf_dir):
    """Alerts as raised: each delivery is judged by the trades known then, and nothing is withdrawn."""
    return alert_table(_replayed(spark, sf_dir, partial(start_gold, alerts=True))[0].alerts).current(spark)


@query
def replay_latest_signals(spark, sf_dir):
    """The view that every batch of signals merges into."""
    paths, _ = _replayed(spark, sf_dir, partial(start_gold, latest=True))
    return _steady(latest_view(paths.latest).current(spark), "sma_15min")


@query
def replay_rsi_14(spark, sf_dir):
    """The index of the bars the watermark has closed, batch by batch."""
    return rsi_table(_replayed(spark, sf_dir, start_rsi)[0].rsi).current(spark)


@query
def replay_batches(spark, sf_dir):
    """Rows read by each micro-batch that had some: one for every delivery, across the restarts."""
    _, progress = _replayed(spark, sf_dir, start_silver)
    read = [count for count in (batch_counts(step)["input_rows"] for step in progress) if count]
    return spark.createDataFrame(list(enumerate(read)), "delivery long, input_rows long")


@query
def stream_topic_messages(spark, sf_dir):
    """Both topics of the faulty feed, written by one stream."""
    folder = scratch_folder(spark, "topics")
    checked = samples.checked_messages(samples.events(spark, sf_dir, stream=True), faulty=True)
    job = write_checked(checked, kind="files", path=f"{folder}/topics", checkpoint=f"{folder}/checkpoint", trigger=_ONCE)
    job.awaitTermination()
    return spark.read.schema("key string, value string, topic string").parquet(f"{folder}/topics")


@query
def stream_component_health(spark, sf_dir):
    paths = JobPaths(scratch_folder(spark, "live"))
    source = samples.events(stream_session(spark), sf_dir, stream=True)
    checked = samples.checked_messages(source, faulty=True)
    start_health(checked, paths, trigger=_ONCE).awaitTermination()
    return health_table(paths.health).current(spark)
