"""The submitted jobs, run once over files."""

from candlewick import __main__ as jobs
from candlewick.operators.bars import ohlcv
from candlewick.operators.ingest import with_event_time
from candlewick.sinks.keyed import alert_table, bar_table, health_table, signal_table
from candlewick.sinks.topic import topic_folder
from candlewick.sources import samples
from candlewick.sources.bronze import read_bronze
from candlewick.streaming.jobs import JobPaths
from helpers import same


def test_feed_to_tables_and_back(spark, tmp_path, small, capsys):
    root, feed, topics = (str(tmp_path / name) for name in ("tables", "feed", "topics"))
    samples.raw_messages(samples.events(spark, small), faulty=True).select("value").write.text(feed)
    jobs.main(["route", "--root", root, "--kind", "files", "--feed", feed, "--path", topics, "--once"])
    jobs.main(["live", "--root", root, "--kind", "files", "--path", topic_folder(topics, "trades"), "--alerts", "--once"])
    paths = JobPaths(root)
    bronze = read_bronze(spark, paths.bronze)
    bars = bar_table(paths.bars).current(spark)
    assert bronze.count() > 800
    assert same(bars, ohlcv(with_event_time(bronze)))
    assert not health_table(paths.health).current(spark).isEmpty()
    assert not alert_table(paths.alerts).current(spark).isEmpty()

    again = str(tmp_path / "again")
    with_event_time(bronze).drop("trade_timestamp").write.partitionBy("date_partition", "symbol").parquet(again + "/bronze")
    jobs.main(["backfill", "--root", again])
    rebuilt = JobPaths(again)
    assert same(bar_table(rebuilt.bars).current(spark), bars)
    key = ["symbol", "window_start", "risk_level", "price_deviation_pct"]
    assert same(signal_table(rebuilt.signals).current(spark).select(key), signal_table(paths.signals).current(spark).select(key))

    jobs.main(["compact", "--root", again])
    assert "bars: base version 0" in capsys.readouterr().out
    assert bar_table(rebuilt.bars).current(spark).isEmpty(), "the bars of January 2024 are past their retention"
