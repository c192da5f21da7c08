from pyspark.sql import functions as F

from candlewick.operators.bars import bars_of, ohlcv
from candlewick.operators.signals import alert_history, signals_of, trading_signals
from candlewick.operators.summaries import merge, summarise
from candlewick.__main__ import main
from candlewick.plans.backfill import backfill, on_days
from candlewick.sinks.bronze import write_bronze
from candlewick.sinks.keyed import alert_table, bar_table, signal_table
from candlewick.sources import samples
from candlewick.sources.bronze import read_bronze
from candlewick.streaming.jobs import JobPaths
from helpers import frame, plan, same, trade

EXACT = ["symbol", "window_start", "window_end", "open", "high", "low", "close", "trade_count", "total_volume", "avg_latency_ms"]


def test_merged_summaries_equal_direct_ones(spark, medium):
    trades = samples.trades(samples.events(spark, medium))
    merged = bars_of(merge(summarise(trades, "5 minutes"), "1 day"), "1 day")
    assert same(merged.select(EXACT), ohlcv(trades, "1 day").select(EXACT))
    signals = signals_of(merge(summarise(trades, "5 minutes"), "15 minutes"))
    columns = ["symbol", "window_start", "close", "buy_volume", "sell_volume", "risk_level", "price_deviation_pct"]
    assert same(signals.select(columns), trading_signals(trades).select(columns))


def test_merge_keeps_null_edges_and_ties(spark):
    rows = frame(spark, [trade(1, None), trade(2, 5.0, minute=6), trade(4, 7.0, minute=12), trade(3, 6.0, minute=12)])
    merged = bars_of(merge(summarise(rows, "5 minutes"), "15 minutes"), "15 minutes").first()
    direct = ohlcv(rows, "15 minutes").first()
    assert merged == direct
    assert (merged.open, merged.close, merged.trade_count) == (None, 7.0, 4)


def test_backfill_fills_all_tables_from_one_scan(spark, tmp_path, small):
    trades = samples.trades(samples.events(spark, small))
    paths = JobPaths(str(tmp_path))
    counts = backfill(trades, paths)
    assert counts["signals"]["high_risk"] == counts["alerts"]["rows"]
    signals = trading_signals(trades)
    steady = lambda rows: rows.withColumns({n: F.round(n, 9) for n in ("sma_15min", "volume_15min")})
    assert same(bar_table(paths.bars).current(spark), ohlcv(trades))
    assert same(steady(signal_table(paths.signals).current(spark)), steady(signals))
    assert same(alert_table(paths.alerts).current(spark), alert_history(signals))
    again = backfill(trades, paths)
    assert again == counts and bar_table(paths.bars).versions(spark).count() == counts["bars"]["rows"]


def test_a_day_has_whole_bars_only(spark, tmp_path):
    """Trades of one bar that were stored on two days, and a bar of the next day that is only half there."""
    late = [trade(n, float(n), minute=1438.0, ingest_delay=delay, date_partition=day)
            for n, delay, day in ((1, 5, "2024/01/01"), (2, 600_000, "2024/01/02"))]
    half = trade(3, 3.0, minute=1441.0, date_partition="2024/01/02")
    paths = JobPaths(str(tmp_path))
    write_bronze(frame(spark, [*late, half]).drop("trade_timestamp"), paths.bronze)
    main(["backfill", "--root", str(tmp_path), "--days", "2024/01/01"])
    (bar,) = bar_table(paths.bars).current(spark).collect()
    assert (bar.open, bar.close, bar.trade_count) == (1.0, 2.0, 2)
    main(["backfill", "--root", str(tmp_path), "--days", "2024/01/02"])
    assert {row.close for row in bar_table(paths.bars).current(spark).collect()} == {2.0, 3.0}


def test_a_day_holds_trades_stored_on_any_day(spark, tmp_path):
    """A replay after an outage, a clock that was days ahead, and an ingest time that is no day."""
    stored = ["2024/01/05", "2024/01/06", "2024/01/20", "2024/02/20", "2024/01/01", None]
    day = 4 * 1440
    rows = [trade(n, float(n), minute=day, date_partition=folder) for n, folder in enumerate(stored, 1)]
    rows += [trade(7, 7.0, minute=day - 0.001, date_partition="2024/01/05"), trade(8, 8.0, minute=day + 1440, date_partition="2024/01/05")]
    paths = JobPaths(str(tmp_path))
    write_bronze(frame(spark, rows).drop("trade_timestamp"), paths.bronze)
    main(["backfill", "--root", str(tmp_path), "--days", "2024/01/05"])
    (bar,) = bar_table(paths.bars).current(spark).collect()
    assert (bar.open, bar.close, bar.trade_count) == (1.0, 6.0, 6)
    (signal,) = signal_table(paths.signals).current(spark).collect()
    assert signal.trade_count == 6


def test_days_reach_the_scan(spark, tmp_path):
    write_bronze(frame(spark, [trade(n, 1.0, minute=1440.0 * n) for n in range(9)]).drop("trade_timestamp"), str(tmp_path))
    stored = read_bronze(spark, str(tmp_path))
    chosen = on_days(stored, ["2024/01/03", "2024/01/02", "2024/01/07"])
    assert "GreaterThanOrEqual(trade_time_ms," in plan(chosen).split("PushedFilters: ")[1].split("\n")[0]
    assert {row.trade_id for row in chosen.collect()} == {"1", "2", "6"} and on_days(stored, []).isEmpty()


def test_sliding_merge_equals_direct(spark, small):
    trades = samples.trades(samples.events(spark, small))
    direct = bars_of(summarise(trades, "5 minutes", "1 minute"))
    assert same(ohlcv(trades, slide="1 minute").select(EXACT), direct.select(EXACT))
