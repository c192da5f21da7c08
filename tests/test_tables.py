"""Keyed tables: newest write wins, repeats change nothing, half-written folders stay unseen."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.operators.signals import trading_signals
from candlewick.operators.tables import latest_signals, retain
from candlewick.sinks.bronze import write_bronze
from candlewick.sinks.keyed import bar_table, health_table, signal_table
from candlewick.sources import samples
from candlewick.sources.bronze import read_bronze
from helpers import plan, same

DAY = datetime.date(2024, 1, 1)
NOON = datetime.datetime(2024, 1, 1, 12)


def signal_rows(spark, *closes, day=DAY, start=NOON):
    rows = [
        (f"S{i}", day, start, close, close, 1.0, 1.0, 0.0, 1, False, 0.0, 1.0, "HIGH" if close > 5 else "LOW", None)
        for i, close in enumerate(closes)
    ]
    return spark.createDataFrame(rows, schemas.SIGNAL)


def closes(table, spark):
    return {row.symbol: row.close for row in table.current(spark).collect()}


def test_empty_table(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    assert table.current(spark).isEmpty()
    assert table.current(spark).columns == schemas.SIGNAL.names
    assert table.compact(spark) is None and table.drop_superseded(spark) == 0


def test_newest_write_wins(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    assert table.upsert(signal_rows(spark, 1.0, 2.0), 0) == {"rows": 2, "high_risk": 0}
    assert table.upsert(signal_rows(spark, 7.0), 1) == {"rows": 1, "high_risk": 1}
    assert closes(table, spark) == {"S0": 7.0, "S1": 2.0}


def test_writers_do_not_replace_each_other(spark, tmp_path):
    """A second writer, or a job begun anew, starts at batch 0 again and must win by time, not by number."""
    table = signal_table(str(tmp_path / "t"))
    table.upsert(signal_rows(spark, 1.0, 2.0), 0, "old")
    table.upsert(signal_rows(spark, 3.0), 5, "old")
    table.upsert(signal_rows(spark, 4.0), 0, "new")
    assert closes(table, spark) == {"S0": 4.0, "S1": 2.0}
    assert table.versions(spark).count() == 4


def test_one_key_in_many_batches(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    for batch_id in (9, 10, 11):
        table.upsert(signal_rows(spark, float(batch_id)), batch_id)
    assert closes(table, spark) == {"S0": 11.0}


def test_repeated_batch_replaces_itself(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    table.upsert(signal_rows(spark, 1.0), 0)
    table.upsert(signal_rows(spark, 2.0), 1)
    table.upsert(signal_rows(spark, 2.0), 1)
    assert closes(table, spark) == {"S0": 2.0}
    assert table.versions(spark).count() == 2


def test_empty_batch_leaves_nothing(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    assert table.upsert(signal_rows(spark, 1.0).filter("false"), 0)["rows"] == 0
    assert not os.path.exists(tmp_path / "t/delta/writer=main/batch_id=0")
    assert table.upsert(signal_rows(spark, 1.0).filter(F.col("close") > 3), 1)["rows"] == 0
    assert table.current(spark).isEmpty()


def test_half_written_batch_is_not_read(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    table.upsert(signal_rows(spark, 1.0), 0)
    table.upsert(signal_rows(spark, 2.0), 1)
    os.remove(tmp_path / "t/delta/writer=main/batch_id=1/_SUCCESS")
    assert closes(table, spark) == {"S0": 1.0}


def test_rows_without_key_are_not_stored(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    rows = signal_rows(spark, 1.0, 2.0).withColumn("symbol", F.when(F.col("close") > 1, F.col("symbol")))
    table.upsert(rows, 0)
    assert closes(table, spark) == {"S1": 2.0}


def test_compaction_keeps_rows_and_later_batches(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    table.upsert(signal_rows(spark, 1.0, 2.0, 3.0), 0)
    table.upsert(signal_rows(spark, 4.0), 1)
    before = table.current(spark).collect()
    assert table.compact(spark) == 0
    assert sorted(table.current(spark).collect()) == sorted(before)
    assert table.versions(spark).count() == 3
    assert table.compact(spark) == 0, "nothing new to fold"
    table.upsert(signal_rows(spark, 4.0), 1)
    assert closes(table, spark) == {"S0": 4.0, "S1": 2.0, "S2": 3.0}
    table.upsert(signal_rows(spark, 9.0, 9.0), 2)
    assert closes(table, spark) == {"S0": 9.0, "S1": 9.0, "S2": 3.0}
    assert table.drop_superseded(spark) == 1, "batch 1 was written again, so the base does not replace it"
    assert closes(table, spark) == {"S0": 9.0, "S1": 9.0, "S2": 3.0}
    assert table.compact(spark) == 1 and table.drop_superseded(spark) == 3
    assert closes(table, spark) == {"S0": 9.0, "S1": 9.0, "S2": 3.0}


def test_a_folded_batch_written_again_shows(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    table.upsert(signal_rows(spark, 1.0, 2.0), 0, "backfill")
    table.compact(spark)
    table.upsert(signal_rows(spark, 5.0), 0, "backfill")
    assert closes(table, spark) == {"S0": 5.0, "S1": 2.0}
    assert table.drop_superseded(spark) == 0, "the new folder is not in the base"
    table.compact(spark)
    assert table.drop_superseded(spark) == 2 and closes(table, spark) == {"S0": 5.0, "S1": 2.0}


def test_unfinished_compaction_is_not_read(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    table.upsert(signal_rows(spark, 1.0, 2.0), 0)
    table.compact(spark)
    os.remove(tmp_path / "t/base/version=0/_SUCCESS")
    assert table.drop_superseded(spark) == 0
    assert closes(table, spark) == {"S0": 1.0, "S1": 2.0}
    assert table.compact(spark) == 0 and closes(table, spark) == {"S0": 1.0, "S1": 2.0}


def test_compaction_applies_retention(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    table.upsert(signal_rows(spark, 1.0), 0)
    old = datetime.datetime(2023, 9, 1, 12)
    table.upsert(signal_rows(spark, 2.0, 3.0, day=old.date(), start=old), 1)
    table.compact(spark, keep_days=90, as_of="2024-01-02 00:00:00")
    assert closes(table, spark) == {"S0": 1.0}


def test_key_filter_reaches_the_folders(spark, tmp_path):
    table = bar_table(str(tmp_path / "t"))
    from candlewick.operators.bars import ohlcv

    table.upsert(ohlcv(samples.trades(samples.events(spark, "/root/testdata/sf0.001"))), 0)
    chosen = table.current(spark).filter("symbol = 'CLICK' AND date_bucket = DATE'2024-01-05'")
    text = plan(chosen)
    assert "PartitionFilters: [isnotnull(date_bucket" in text and "2024-01-05" in text
    assert "EqualTo(symbol,CLICK)" in text
    assert chosen.count() > 0


def test_current_prefilters_before_the_shuffle(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    for batch_id in (0, 1):
        table.upsert(signal_rows(spark, 1.0), batch_id)
    assert "WindowGroupLimit" in plan(table.current(spark), "simple")


def test_files_are_sorted_newest_first(spark, tmp_path):
    table = signal_table(str(tmp_path / "t"))
    rows = trading_signals(samples.trades(samples.events(spark, "/root/testdata/sf0.001")))
    table.upsert(rows, 0)
    for folder, _, files in os.walk(tmp_path / "t/delta/writer=main/batch_id=0"):
        for name in files:
            if name.endswith(".parquet"):
                stored = spark.read.parquet(os.path.join(folder, name)).select("symbol", "window_start").collect()
                assert stored == sorted(stored, key=lambda row: (row.symbol, -row.window_start.timestamp()))


def test_table_without_bucket(spark, tmp_path):
    table = health_table(str(tmp_path / "t"))
    row = ("producer", NOON, 1.0, 0.0, 5.0, "{}")
    table.upsert(spark.createDataFrame([row], schemas.HEALTH), 0)
    table.upsert(spark.createDataFrame([("producer", NOON, 2.0, 0.0, 5.0, "{}")], schemas.HEALTH), 1)
    assert [r.messages_per_sec for r in table.current(spark).collect()] == [2.0]


def test_latest_signal_per_symbol(spark, medium):
    rows = trading_signals(samples.trades(samples.events(spark, medium)))
    latest = latest_signals(rows)
    assert latest.count() == 5
    newest = rows.groupBy("symbol").agg(F.max("window_start").alias("window_start"))
    assert same(latest.select("symbol", "window_start"), newest)


@pytest.mark.parametrize("days, kept", [(1, 1), (0, 0)])
def test_retention_edge_is_inclusive(spark, days, kept):
    rows = signal_rows(spark, 1.0)
    assert retain(rows, "window_start", days, "2024-01-02 12:00:00").count() == kept


def test_bronze_round_trip_and_pruning(spark, tmp_path, medium):
    trades = samples.trades(samples.events(spark, medium)).drop("trade_timestamp")
    path = str(tmp_path / "bronze")
    write_bronze(trades, path)
    assert same(read_bronze(spark, path), trades)
    some = read_bronze(spark, path, days=["2024/01/05", "2024/01/06"], symbols=["CLICK"])
    pruned = plan(some).split("PartitionFilters: ")[1].split("\n")[0]
    assert "2024/01/05" in pruned and "CLICK" in pruned
    assert 0 < some.count() == trades.filter(
        "symbol = 'CLICK' AND date_partition IN ('2024/01/05', '2024/01/06')"
    ).count()


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_one_hot_folder_is_split_over_tasks(spark, tmp_path, adaptive):
    """A symbol with most of the rows must not end in one task and one file."""
    rows = spark.range(400_000).select(
        F.col("id").cast("string").alias("trade_id"),
        F.when(F.col("id") % 10 < 9, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 20)).alias("symbol"),
        F.lit("2024/01/01").alias("date_partition"),
        F.rand(1).alias("price"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        write_bronze(rows, str(tmp_path / "b"), tasks_per_folder=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    day = tmp_path / "b" / "date_partition=2024%2F01%2F01"
    files = {name: len([f for f in os.listdir(day / name) if f.endswith(".parquet")]) for name in os.listdir(day)}
    assert files.pop("symbol=HOT") > 1
    assert max(files.values()) <= (1 if adaptive == "true" else 2)
