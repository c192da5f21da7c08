import datetime

import pytest
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.operators import health, serving
from candlewick.operators.bars import ohlcv
from candlewick.operators.ingest import rejected, topic_rows
from candlewick.sources import samples
from helpers import frame, trade

NOW = datetime.datetime(2024, 1, 15, 18, 30)


@pytest.fixture(scope="module")
def bars(spark):
    return ohlcv(samples.trades(samples.events(spark, "/root/testdata/sf0.01"))).cache()


def test_today_means_the_current_utc_day(spark, bars):
    rows = serving.recent_bars(bars, "CLICK", NOW).collect()
    starts = [row.window_start for row in rows]
    assert rows and {start.date() for start in starts} == {NOW.date()}
    assert starts == sorted(starts, reverse=True)


def test_last_day_spans_two_days(spark, bars):
    starts = [row.window_start for row in serving.last_day_bars(bars, "CLICK", NOW).collect()]
    assert {start.day for start in starts} == {14, 15}
    assert all(NOW - datetime.timedelta(hours=24) < start <= NOW for start in starts)


def test_a_day_of_sliding_bars_comes_whole(spark):
    trades = samples.trades(samples.events(spark, "/root/testdata/sf0.1"))
    rows = serving.last_day_bars(ohlcv(trades, slide="1 minute"), "CLICK", NOW)
    assert rows.count() > 288


def test_without_a_moment_now_counts(spark):
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    rows = [("producer", now - datetime.timedelta(minutes=minutes), 1.0, 0.0, 1.0, "{}") for minutes in (5, 70)]
    assert serving.recent_health(spark.createDataFrame(rows, schemas.HEALTH)).count() == 1


def test_first_metric(spark):
    row = health.first_metric(spark, NOW).first()
    assert (row.component, row.metric_time, row.extra_json) == ("system", NOW, '{"status": "initialized"}')


def test_limit(spark, bars):
    assert len(serving.recent_bars(bars, "CLICK", NOW, limit=3).collect()) == 3


def test_day_without_rows(spark, bars):
    assert serving.recent_bars(bars, "CLICK", "2030-01-01 00:00:00").isEmpty()


def test_health_exactly_one_hour_old_is_out(spark):
    times = [NOW - datetime.timedelta(minutes=60), NOW - datetime.timedelta(minutes=59), NOW]
    rows = [("producer", at, 1.0, 0.0, 1.0, "{}") for at in times] + [("other", NOW, 1.0, 0.0, 1.0, "{}")]
    got = serving.recent_health(spark.createDataFrame(rows, schemas.HEALTH), NOW).collect()
    assert [row.metric_time for row in got] == [times[2], times[1]]


def test_histogram_is_cumulative_and_counts_edges(spark):
    trades = frame(spark, [trade(i, 1.0, latency_ms=ms) for i, ms in enumerate([0, 1, 2, 5, 500, 501, -3])])
    got = {row.le: row.observations for row in health.latency_histogram(trades).collect()}
    assert got == {"1": 3, "5": 5, "10": 5, "25": 5, "50": 5, "100": 5, "250": 5, "500": 6, "+Inf": 7}


def test_last_trade_is_the_last_received(spark):
    trades = frame(spark, [trade(1, 1.0, minute=9, ingest_delay=1), trade(2, 1.0, minute=5, ingest_delay=900_000)])
    assert health.last_trade(trades).first().last_trade_time_ms == trade(2, 1.0, minute=5)["trade_time_ms"]


def test_counts_add_up(spark, small):
    checked = samples.checked_messages(samples.events(spark, small), faulty=True)
    letters = health.dead_letter_counts(rejected(checked)).agg(F.sum("dead_letters")).first()[0]
    topics = {row.topic: row.messages for row in health.message_counts(topic_rows(checked)).collect()}
    assert topics["trades_dlq"] == letters and sum(topics.values()) == 1000


def test_health_rates(spark):
    from candlewick.operators.ingest import check

    start = 1_704_067_200_000
    good = '{"e":"x","E":1,"s":"a","t":1,"p":"1","q":"1","T":%d,"m":true}' % (start + 1000)
    raw = spark.createDataFrame([(good, start + 1010), (good, start + 1030), ("bad", start + 59_999)], "value string, at long")
    row = health.component_health(health.with_ingest_time(check(raw, F.col("at")))).first()
    assert (row.component, row.metric_time) == ("producer", datetime.datetime(2024, 1, 1, 0, 1))
    assert (row.messages_per_sec, row.error_rate, row.avg_latency_ms) == (0.05, 0.3333, 20.0)
    assert row.extra_json == '{"accepted":2,"dead_letters":1}'
