"""Live jobs: equal to batch, late rows, restarts and repeated batches."""

import os

import pytest
from pyspark.sql import functions as F

from candlewick import schemas, settings
from candlewick.operators.bars import ohlcv
from candlewick.operators.health import component_health, with_ingest_time
from candlewick.operators.ingest import accepted, check, with_event_time, without_repeats
from candlewick.operators.signals import alert_history, trading_signals
from candlewick.session import stream_session
from candlewick.sinks.bronze import write_bronze
from candlewick.sinks.keyed import alert_table, bar_table, health_table, signal_table
from candlewick.sinks.topic import topic_folder, write_checked, write_dead_letters
from candlewick.sources import samples
from candlewick.sources.bronze import read_bronze
from candlewick.sources.topic import decode_trades, read_raw_messages, read_topic
from candlewick.streaming.jobs import JobPaths, live_trades, start_all, start_bronze, start_gold, start_health, start_silver
from helpers import frame, plan, put_topic_file, same, trade

ONCE = {"availableNow": True}
SUMS = ("sma_15min", "volume_15min", "buy_volume", "sell_volume")


def steady(rows):
    return rows.withColumns({name: F.round(name, 6) for name in SUMS if name in rows.columns})


def feed(count=400):
    """Trades of three symbols over four hours, prices in whole cents of eighths so that sums are exact."""
    symbols = ("AAA", "BBB", "CCC")
    return [
        trade(n, 100.0 + (n * 37 % 64) / 8, 1.0 + n % 5, maker=n % 3 == 0, minute=n * 240 / count, symbol=symbols[n * n % 3])
        for n in range(count)
    ]


def put_feed(folder, trades, files, first=0):
    size = -(-len(trades) // files)
    for i in range(files):
        put_topic_file(folder, first + i, trades[i * size:(i + 1) * size])


def source(spark, folder, per_trigger=1):
    return live_trades(spark, kind="files", path=folder, max_per_trigger=per_trigger)


def run(query):
    query.awaitTermination()
    return query


def test_stream_equals_batch_over_many_batches(spark, tmp_path):
    folder, trades = str(tmp_path / "topic"), feed()
    put_feed(folder, trades, 5)
    paths = JobPaths(str(tmp_path / "live"))
    queries = start_all(spark, paths, trigger=ONCE, alerts=True, kind="files", path=folder, max_per_trigger=1)
    for query in queries:
        run(query)
    batch = frame(spark, trades)
    assert same(read_bronze(spark, paths.bronze), batch.drop("trade_timestamp"))
    assert same(steady(bar_table(paths.bars).current(spark)), steady(ohlcv(batch)))
    assert same(steady(signal_table(paths.signals).current(spark)), steady(trading_signals(batch)))
    emitted = bar_table(paths.bars).versions(spark)
    assert emitted.count() > ohlcv(batch).count()
    assert emitted.select("written_at").distinct().count() >= 5
    final = alert_history(trading_signals(batch)).select("symbol", "alert_time", "risk_level")
    seen = alert_table(paths.alerts).current(spark).select("symbol", "alert_time", "risk_level")
    assert final.exceptAll(seen).isEmpty()


def test_windowed_jobs_decode_only_what_they_use(spark, tmp_path):
    folder = str(tmp_path / "topic")
    put_feed(folder, feed(20), 1)
    for schema, unused in ((schemas.SILVER_INPUT, "is_buyer_maker"), (schemas.GOLD_INPUT, "notional_usd")):
        trades = live_trades(spark, schema, kind="files", path=folder)
        assert trades.columns == [*schema.names, "trade_timestamp"]
        assert unused not in plan(trades, "simple")


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    folder, trades = str(tmp_path / "topic"), feed()
    put_feed(folder, trades[:250], 2)
    paths = JobPaths(str(tmp_path / "live"))
    run(start_silver(source(spark, folder), paths, trigger=ONCE))
    put_feed(folder, trades[250:], 2, first=2)
    run(start_silver(source(spark, folder), paths, trigger=ONCE))
    assert same(steady(bar_table(paths.bars).current(spark)), steady(ohlcv(frame(spark, trades))))


def test_repeated_batch_changes_nothing(spark, tmp_path):
    """The last batch is run again, as after a crash between its write and its commit."""
    folder, trades = str(tmp_path / "topic"), feed()
    put_feed(folder, trades, 4)
    paths = JobPaths(str(tmp_path / "live"))
    run(start_silver(source(spark, folder), paths, trigger=ONCE))
    table = bar_table(paths.bars)
    before = steady(table.versions(spark).drop("written_at")).collect()
    commits = os.path.join(paths.checkpoint("silver"), "commits")
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.remove(os.path.join(commits, name))
    run(start_silver(source(spark, folder), paths, trigger=ONCE))
    assert sorted(steady(table.versions(spark).drop("written_at")).collect()) == sorted(before)
    assert same(steady(table.current(spark)), steady(ohlcv(frame(spark, trades))))


def test_job_begun_anew_overwrites_nothing(spark, tmp_path):
    """Lost checkpoints: batch ids start at 0 again, over other files, yet the bars written before stay."""
    first, second, trades = str(tmp_path / "first"), str(tmp_path / "second"), feed()
    put_feed(first, trades[:200], 2)
    put_feed(second, [row for row in trades if row["trade_time_ms"] >= trades[200]["trade_time_ms"] // 300_000 * 300_000], 2)
    paths, anew = JobPaths(str(tmp_path / "live")), JobPaths(str(tmp_path / "live"), str(tmp_path / "other"))
    run(start_silver(source(spark, first), paths, trigger=ONCE))
    run(start_silver(source(spark, second), anew, trigger=ONCE))
    assert same(bar_table(paths.bars).current(spark), ohlcv(frame(spark, trades)))


def test_compaction_between_batches(spark, tmp_path):
    folder, trades = str(tmp_path / "topic"), feed()
    put_feed(folder, trades[:250], 2)
    paths = JobPaths(str(tmp_path / "live"))
    table = signal_table(paths.signals)
    run(start_gold(source(spark, folder), paths, trigger=ONCE))
    table.compact(spark)
    table.drop_superseded(spark)
    put_feed(folder, trades[250:], 2, first=2)
    run(start_gold(source(spark, folder), paths, trigger=ONCE))
    assert same(steady(table.current(spark)), steady(trading_signals(frame(spark, trades))))


def test_late_rows(spark, tmp_path):
    """Bars ignore a row behind the watermark; Bronze keeps it. The filter lags the watermark by a batch."""
    folder = str(tmp_path / "topic")
    batches = [
        [trade(1, 10.0, minute=1), trade(2, 10.0, minute=30)],
        [trade(3, 10.0, minute=2)],
        [trade(4, 10.0, minute=3), trade(5, 10.0, minute=31)],
    ]
    for number, trades in enumerate(batches):
        put_topic_file(folder, number, trades)
    paths = JobPaths(str(tmp_path / "live"))
    query = run(start_silver(source(spark, folder), paths, trigger=ONCE))
    run(start_bronze(source(spark, folder), paths, trigger=ONCE))
    dropped = sum(
        operator["numRowsDroppedByWatermark"] for step in query.recentProgress for operator in step["stateOperators"]
    )
    assert dropped == 1
    counts = {row.window_start.minute: row.trade_count for row in bar_table(paths.bars).current(spark).collect()}
    assert counts == {0: 2, 30: 2}
    assert read_bronze(spark, paths.bronze).count() == 5


def test_rows_within_the_tolerance_still_count(spark, tmp_path):
    folder = str(tmp_path / "topic")
    for number, minute in enumerate([30, 30, 30, 21, 24]):
        put_topic_file(folder, number, [trade(number, 10.0, minute=minute)])
    paths = JobPaths(str(tmp_path / "live"))
    run(start_silver(source(spark, folder), paths, trigger=ONCE))
    counts = {row.window_start.minute: row.trade_count for row in bar_table(paths.bars).current(spark).collect()}
    assert counts == {20: 2, 30: 3}


def test_repeated_deliveries_are_counted_unless_dropped(spark, tmp_path):
    folder = str(tmp_path / "topic")
    for number in range(3):
        put_topic_file(folder, number, [trade(1, 10.0, minute=1)])
    plain, single = JobPaths(str(tmp_path / "plain")), JobPaths(str(tmp_path / "single"))
    run(start_silver(source(spark, folder), plain, trigger=ONCE))
    run(start_silver(without_repeats(source(spark, folder)), single, trigger=ONCE))
    assert bar_table(plain.bars).current(spark).first().trade_count == 3
    assert bar_table(single.bars).current(spark).first().trade_count == 1


def test_one_pass_routing_of_a_raw_stream(spark, tmp_path, small):
    raw = samples.raw_messages(samples.events(spark, small), faulty=True)
    raw.select("value").write.text(str(tmp_path / "feed"))
    stamped = F.lit(1704067200000)
    checked = check(read_raw_messages(spark, str(tmp_path / "feed"), stream=True, max_files=1), stamped)
    out = str(tmp_path / "topics")
    run(write_checked(checked, kind="files", path=out, checkpoint=str(tmp_path / "c"), trigger=ONCE))
    read = lambda topic: spark.read.schema("key string, value string").parquet(topic_folder(out, topic))
    stored = decode_trades(read(settings.TRADES_TOPIC))
    assert same(stored, accepted(check(spark.read.text(str(tmp_path / "feed")), stamped)))
    letters = read(settings.DEAD_LETTER_TOPIC)
    assert stored.count() + letters.count() == 1000
    assert letters.filter("key <> 'dlq'").isEmpty()
    parsed = letters.select(F.from_json("value", schemas.DEAD_LETTER).alias("d")).select("d.*")
    assert parsed.filter("raw_message IS NULL OR error_reason IS NULL OR received_at IS NULL").isEmpty()


def test_dead_letters_alone(spark, tmp_path, small):
    checked = samples.checked_messages(samples.events(spark, small), faulty=True)
    write_dead_letters(checked, kind="files", path=str(tmp_path / "t"))
    assert os.listdir(tmp_path / "t").count("topic=trades_dlq") == 1
    assert not os.path.exists(topic_folder(str(tmp_path / "t"), "trades"))


def test_topic_feeds_the_live_job(spark, tmp_path, small):
    """Raw messages -> topic files -> live bars equals bars of the accepted trades."""
    checked = samples.checked_messages(samples.events(spark, small))
    write_checked(checked, kind="files", path=str(tmp_path / "t"))
    paths = JobPaths(str(tmp_path / "live"))
    run(start_silver(source(spark, topic_folder(str(tmp_path / "t"), "trades"), None), paths, trigger=ONCE))
    assert same(steady(bar_table(paths.bars).current(spark)), steady(ohlcv(with_event_time(accepted(checked)))))


def test_rate_limit(spark, tmp_path):
    folder = str(tmp_path / "topic")
    put_feed(folder, feed(60), 6)
    paths = JobPaths(str(tmp_path / "live"))
    query = run(start_bronze(source(spark, folder, per_trigger=2), paths, trigger=ONCE))
    assert [step["numInputRows"] for step in query.recentProgress if step["numInputRows"]] == [20, 20, 20]


def test_gathered_bronze_writes_few_files(spark, tmp_path):
    folder = str(tmp_path / "topic")
    put_feed(folder, feed(), 8)
    trades = decode_trades(read_topic(spark, "files", path=folder))
    out = str(tmp_path / "b")
    run(write_bronze(trades, out, str(tmp_path / "c"), ONCE, tasks_per_folder=2))
    for symbol in ("AAA", "BBB", "CCC"):
        stored = f"{out}/date_partition=2024%2F01%2F01/symbol={symbol}"
        if os.path.isdir(stored):
            assert len([name for name in os.listdir(stored) if name.endswith(".parquet")]) <= 2
    assert read_bronze(spark, out).count() == 400


def test_micro_batches_write_few_files_per_bucket(spark, tmp_path):
    folder, trades = str(tmp_path / "topic"), feed()
    put_feed(folder, trades, 4)
    paths = JobPaths(str(tmp_path / "live"))
    session = stream_session(spark, state_partitions=32)
    run(start_silver(source(session, folder, 4), paths, trigger=ONCE))
    for place, _, files in os.walk(paths.bars + "/delta"):
        assert len([name for name in files if name.endswith(".parquet")]) <= 4
    assert same(bar_table(paths.bars).current(spark), ohlcv(frame(spark, trades)))


def test_health_stream_writes_few_files(spark, tmp_path, small):
    session = stream_session(spark, state_partitions=32)
    paths = JobPaths(str(tmp_path / "live"))
    checked = samples.checked_messages(samples.events(session, small, stream=True), faulty=True)
    run(start_health(checked, paths, trigger=ONCE))
    for place, _, files in os.walk(paths.health + "/delta"):
        assert len([name for name in files if name.endswith(".parquet")]) <= 4
    batch = component_health(with_ingest_time(samples.checked_messages(samples.events(spark, small), faulty=True)))
    assert same(health_table(paths.health).current(spark), batch)


def test_append_mode_emits_each_bar_once(spark, tmp_path):
    folder, trades = str(tmp_path / "topic"), feed()
    put_feed(folder, trades, 4)
    query = (
        ohlcv(source(spark, folder)).writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
        .trigger(**ONCE).outputMode("append").start()
    )
    run(query)
    closed = spark.read.schema(schemas.BAR).parquet(str(tmp_path / "out"))
    assert closed.count() == closed.select("symbol", "window_start").distinct().count()
    batch = steady(ohlcv(frame(spark, trades)))
    assert steady(closed).exceptAll(batch).isEmpty()
    assert 0 < closed.count() < batch.count()


def test_sliding_bars_stream(spark, tmp_path):
    folder, trades = str(tmp_path / "topic"), feed(80)
    put_feed(folder, trades, 2)
    from candlewick.streaming.jobs import start_upsert

    table = bar_table(str(tmp_path / "bars"))
    run(start_upsert(ohlcv(source(spark, folder), slide="1 minute"), table, str(tmp_path / "c"), ONCE))
    assert same(steady(table.current(spark)), steady(ohlcv(frame(spark, trades), slide="1 minute")))


def test_unknown_topic_kind(spark):
    with pytest.raises(ValueError):
        read_topic(spark, "tape")
    with pytest.raises(ValueError):
        write_checked(spark.range(1).selectExpr(
            "'a' raw_message", "1L ingest_time_ms", "'1' trade_id", "'a' symbol", "1D price", "1D quantity",
            "true is_buyer_maker", "1L trade_time_ms", "1L event_time_ms", "'x' error_reason"), kind="tape")
