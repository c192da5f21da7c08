"""Jobs over many micro-batches: replays with late rows and restarts, clocks that run ahead, logs, health of several jobs."""

import json
import logging
import os

import pytest
from pyspark.sql import functions as F

from candlewick.__main__ import main
from candlewick.operators.bars import ohlcv
from candlewick.operators.ingest import IMPLAUSIBLE, accepted, check, rejected, with_event_time
from candlewick.sinks.keyed import bar_table, health_table, pane_table, rsi_table
from candlewick.sources import samples
from candlewick.sources.bronze import read_bronze
from candlewick.sources.topic import read_raw_messages
from candlewick.streaming.jobs import JobPaths, start_bronze, start_health, start_panes, start_rsi, start_silver
from candlewick.streaming.progress import JobLog, batch_counts
from candlewick.streaming.replay import replay
from helpers import MINUTE, START, same

ONCE = {"availableNow": True}


def events(spark, rows):
    """(number, minute, price, delivery) as events of one symbol."""
    told = [(n, int(START + minute * MINUTE), price, delivery) for n, minute, price, delivery in rows]
    return spark.createDataFrame(told, "event_id long, at long, value double, delivery int").select(
        "event_id",
        F.timestamp_millis("at").cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("long").alias("user_id"), F.lit("click").alias("event_type"), "value",
        F.lit('{"k": 2}').alias("props"), "delivery",
    )


def run(spark, rows, start, folder, sessions, lateness="10 minutes"):
    paths = JobPaths(f"{folder}/live")
    progress = replay(
        events(spark, rows), folder, lambda found: start(samples.trades(found, lateness), paths, trigger=ONCE), sessions
    )
    return paths, [count for count in map(batch_counts, progress)]


def test_each_delivery_is_a_micro_batch_and_restarts_keep_the_state(spark, tmp_path):
    rows = [(n, n * 3.0, 10.0 + n, n // 4) for n in range(24)]
    paths, counts = run(spark, rows, start_silver, str(tmp_path), [[0, 1], [2], [3, 4, 5]])
    assert [count["input_rows"] for count in counts if count["input_rows"]] == [4] * 6
    whole = samples.trades(events(spark, rows))
    assert same(bar_table(paths.bars).current(spark), ohlcv(whole))
    assert bar_table(paths.bars).versions(spark).count() > ohlcv(whole).count(), "bars grew over batches"


def test_rows_behind_the_watermark_are_left_out_and_counted(spark, tmp_path):
    rows = [(1, 1, 10.0, 0), (2, 30, 10.0, 0), (3, 60, 10.0, 1), (4, 2, 10.0, 3), (5, 90, 10.0, 2), (6, 85, 10.0, 3)]
    paths, counts = run(spark, rows, start_silver, str(tmp_path), [[0, 1, 2], [3]])
    assert sum(count["late_rows"] for count in counts) == 1
    assert {row.window_start.hour * 60 + row.window_start.minute: row.trade_count
            for row in bar_table(paths.bars).current(spark).collect()} == {0: 1, 30: 1, 60: 1, 85: 1, 90: 1}


def test_bronze_of_a_replay_has_everything_in_few_files(spark, tmp_path):
    rows = [(n, n * 3.0, 10.0 + n, n % 3) for n in range(24)]
    paths, _ = run(spark, rows, start_bronze, str(tmp_path), [[0, 1, 2]])
    assert read_bronze(spark, paths.bronze).count() == 24
    for place, _, files in os.walk(f"{paths.bronze}"):
        if "symbol=" in place:
            assert len([name for name in files if name.endswith(".parquet")]) <= 3 * 4


def test_panes_keep_one_row_of_state_for_a_slide(spark, tmp_path):
    rows = [(n, 10 + (n % 3) * 0.2, 10.0 + n, 0) for n in range(30)]
    plain, sliding = (
        run(spark, rows, start, str(tmp_path / name), [[0]])[1]
        for name, start in (("panes", start_panes), ("copies", lambda trades, paths, trigger: start_silver_sliding(trades, paths, trigger)))
    )
    assert max(count["state_rows"] for count in plain) == 1
    assert max(count["state_rows"] for count in sliding) == 5
    assert pane_table(f"{tmp_path}/panes/live/panes").current(spark).first()["trade_count"] == 30


def start_silver_sliding(trades, paths, trigger):
    from candlewick.streaming.jobs import start_upsert

    return start_upsert(ohlcv(trades, slide="1 minute"), bar_table(paths.bars), paths.checkpoint("sliding"), trigger)


def test_a_batch_of_the_index_that_is_run_again_changes_nothing(spark, tmp_path):
    rows = [(n, n * 5.0, 10.0 + n * n % 7, n // 10) for n in range(60)]
    paths, _ = run(spark, rows, start_rsi, str(tmp_path), [[0, 1, 2], [3, 4, 5]])
    before = sorted(map(tuple, rsi_table(paths.rsi).current(spark).collect()))
    assert len(before) == 57 and sum(row[-1] is not None for row in before) == 43  # three bars are still open
    commits = os.path.join(paths.checkpoint("rsi"), "commits")
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.remove(os.path.join(commits, name))
    stream = spark.readStream.schema(events(spark, rows).drop("delivery").schema).parquet(f"{tmp_path}/feed")
    start_rsi(samples.trades(stream, "10 minutes"), paths, trigger=ONCE).awaitTermination()
    assert sorted(map(tuple, rsi_table(paths.rsi).current(spark).collect())) == before


# -- clocks that run ahead -------------------------------------------------------------------------------


def message(number, minute, ahead_ms=0):
    at = int(START + minute * MINUTE) + ahead_ms
    return json.dumps({"e": "trade", "E": at, "s": "BTC", "t": number, "p": "10", "q": "1", "T": at, "m": False})


def put_lines(folder, number, lines):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/part-{number}.txt"
    with open(path, "w") as file:
        file.write("\n".join(lines))
    os.utime(path, (1_700_000_000 + number * 10,) * 2)


@pytest.mark.parametrize("max_ahead_ms, counted", [(None, 2), (3_600_000, 5)])
def test_one_message_far_ahead_makes_the_rest_late_unless_it_is_rejected(spark, tmp_path, max_ahead_ms, counted):
    """The second batch holds a trade said to be in the next century; the third to fifth bring the trades of today."""
    feed, day = str(tmp_path / "feed"), 86_400_000
    batches = [
        [message(1, 0)], [message(2, 1), message(99, 2, ahead_ms=30_000 * day)], [message(3, 6)], [message(4, 12)], [message(5, 18)],
    ]
    for number, lines in enumerate(batches):
        put_lines(feed, number, lines)
    stamp = F.lit(START + 20 * MINUTE)
    checked = check(read_raw_messages(spark, feed, stream=True, max_files=1), stamp, max_ahead_ms=max_ahead_ms)
    paths = JobPaths(str(tmp_path / "live"))
    start_silver(with_event_time(accepted(checked), "10 minutes"), paths, trigger=ONCE).awaitTermination()
    today = bar_table(paths.bars).current(spark).filter("window_start < '2025-01-01'")
    found = today.agg(F.sum("trade_count")).first()[0]
    assert found == counted if max_ahead_ms else found < 5
    letters = rejected(check(spark.read.text(feed), stamp, max_ahead_ms=max_ahead_ms)).collect()
    assert [row["error_reason"].split(":")[0] for row in letters] == ([IMPLAUSIBLE] if max_ahead_ms else [])


def test_how_far_ahead_is_too_far(spark):
    edge = [0, 1000, 1001, -10**12, 2**62]
    rows = [(json.dumps({"e": "t", "E": 1, "s": "a", "t": 1, "p": 1, "q": 1, "T": START + ahead, "m": 0}),) for ahead in edge]
    raw = spark.createDataFrame([*rows, ('{"e":"t","E":1,"s":"a","t":1,"p":1,"q":1,"T":9223372036854775807,"m":0}',)], "value string")
    reasons = [row["error_reason"] for row in check(raw, F.lit(START), max_ahead_ms=1000).collect()]
    assert reasons[:2] == [None, None] and reasons[2] == f"{IMPLAUSIBLE}: T={START + 1001}" and reasons[3] is None
    assert all(reason and reason.startswith(IMPLAUSIBLE) for reason in reasons[4:])
    assert [row["error_reason"] for row in check(raw, F.lit(START)).collect()] == [None] * 6


# -- logs and health -------------------------------------------------------------------------------------


def test_jobs_log_their_batches(spark, tmp_path, caplog):
    log = JobLog(most=2)
    spark.streams.addListener(log)
    try:
        rows = [(n, n * 3.0, 10.0, n // 2) for n in range(8)]
        with caplog.at_level(logging.INFO, logger="candlewick.streaming.progress"):
            _, counts = run(spark, rows, start_silver, str(tmp_path), [[0, 1, 2, 3]])
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(log)
    if log.batches:  # the listener of a session only hears the jobs of that session
        assert len(log.batches) <= 2 and {"job", "batch_id", "input_rows", "late_rows", "state_rows"} == set(log.batches[-1])
    assert sum(count["input_rows"] for count in counts) == 8


def test_health_of_two_jobs_side_by_side(spark, tmp_path, small):
    paths = JobPaths(str(tmp_path))
    for component in ("producer", "mirror"):
        checked = samples.checked_messages(samples.events(spark, small, stream=True), faulty=True)
        start_health(checked, paths, trigger=ONCE, component=component).awaitTermination()
    rows = health_table(paths.health).current(spark).groupBy("component").count().collect()
    assert {row["component"] for row in rows} == {"producer", "mirror"} and len({row["count"] for row in rows}) == 1


def test_submitted_jobs_with_all_options(spark, tmp_path, small, monkeypatch):
    from candlewick import __main__ as jobs

    monkeypatch.setattr(jobs, "build_session", lambda name: spark)
    feed, root = str(tmp_path / "feed"), str(tmp_path / "root")
    samples.raw_messages(samples.events(spark, small), faulty=True).select("value").write.text(feed)
    topics = str(tmp_path / "topics")
    main(["route", "--root", root, "--feed", feed, "--kind", "files", "--path", topics, "--once", "--component", "east"])
    main(["live", "--root", root, "--kind", "files", "--path", f"{topics}/topic=trades", "--once", "--alerts", "--latest",
          "--rsi", "--panes"])
    main(["backfill", "--root", root, "--days", "2024/01/09"])
    paths = JobPaths(root)
    assert {row[0] for row in health_table(paths.health).current(spark).select("component").distinct().collect()} == {"system", "east"}
    whole = ohlcv(with_event_time(read_bronze(spark, paths.bronze)))
    assert same(bar_table(paths.bars).current(spark), whole)
    assert pane_table(paths.panes).current(spark).agg(F.sum("trade_count")).first()[0] == read_bronze(spark, paths.bronze).count()
    main(["expire", "--root", root])
    assert bar_table(paths.bars).current(spark).isEmpty() and not rsi_table(paths.rsi).current(spark).isEmpty()


