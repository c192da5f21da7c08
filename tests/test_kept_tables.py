"""Reads pruned by day and symbol, day-wise retention, counts on the way, merged views, zones of Bronze files."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.operators import serving
from candlewick.operators.bars import bars_of, ohlcv
from candlewick.operators.indicators import last_closes, rsi, rsi_after
from candlewick.operators.ingest import without_repeats
from candlewick.operators.signals import trading_signals
from candlewick.operators.summaries import panes, summaries_of, summarise
from candlewick.operators.tables import latest_signals, merged_latest
from candlewick.sinks.bronze import write_bronze
from candlewick.sinks.keyed import alert_table, bar_table, health_table, signal_table
from candlewick.sinks.views import MergedView
from candlewick.sources import samples
from candlewick.sources.bronze import read_bronze, read_days, refresh_zones
from candlewick.streaming.jobs import JobPaths, seed_health
from helpers import frame, plan, same, trade

NOW = datetime.datetime(2024, 1, 15, 18, 30)


@pytest.fixture(scope="module")
def trades(spark, small):
    return samples.trades(samples.events(spark, small))


@pytest.fixture(scope="module")
def bars(spark, trades, tmp_path_factory):
    table = bar_table(str(tmp_path_factory.mktemp("bars")))
    table.upsert(ohlcv(trades), 0)
    table.upsert(ohlcv(trades.filter("symbol = 'CLICK'")), 1)
    return table


# -- pruned reads ----------------------------------------------------------------------------------------


def test_a_dashboard_read_opens_one_day(spark, bars):
    text = plan(serving.recent_bars(bars.current(spark), "CLICK", NOW))
    filters = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert filters and all("date_bucket" in line and "2024-01-15" in line for line in filters)
    pushed = [line for line in text.splitlines() if "PushedFilters" in line]
    assert all("EqualTo(symbol,CLICK)" in line for line in pushed)


def test_two_days_at_most_for_the_last_24_hours(spark, bars):
    text = plan(serving.last_day_bars(bars.current(spark), "CLICK", NOW))
    filters = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert filters and all("2024-01-14" in line and "2024-01-15" in line for line in filters)


def test_time_bounds_prune_a_bucket_that_is_not_in_the_rows(spark, trades, tmp_path):
    from candlewick.operators.signals import alert_history

    table, alerts = alert_table(str(tmp_path / "a")), alert_history(trading_signals(trades))
    table.upsert(alerts, 0)
    day = table.current(spark, since="2024-01-15 00:00:00", until="2024-01-15 12:00:00")
    assert day.columns == schemas.ALERT.names
    assert same(day, alerts.filter("alert_time between '2024-01-15 00:00:00' and '2024-01-15 12:00:00'"))
    assert "alert_day" in next(line for line in plan(day).splitlines() if "PartitionFilters" in line)
    assert same(table.current(spark), alerts)


def test_files_of_many_symbols_have_a_bloom_filter(spark, tmp_path):
    """Parquet writes one where the symbols outgrow the file's dictionary, which serves the same end before."""
    table = bar_table(str(tmp_path / "b"))
    row = [F.lit(None).cast(item.dataType).alias(item.name) for item in schemas.BAR.fields[4:]]
    many = spark.range(150_000).coalesce(1).select(
        F.sha2(F.col("id").cast("string"), 256).alias("symbol"), F.lit(NOW.date()).alias("date_bucket"),
        F.lit(NOW).alias("window_start"), F.lit(NOW).alias("window_end"), *row,
    )
    table.upsert(many, 0)
    jvm, filtered = spark._jvm.org.apache, []
    for file in glob.glob(f"{table.path}/delta/*/*/*/*.parquet"):
        source = jvm.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.hadoop.fs.Path(file), spark._jsc.hadoopConfiguration())
        reader = jvm.parquet.hadoop.ParquetFileReader.open(source)
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        filtered.append([
            columns.get(i).getPath().toDotString() for i in range(columns.size()) if columns.get(i).getBloomFilterOffset() > 0
        ])
        reader.close()
    assert ["symbol"] in filtered and all(names in ([], ["symbol"]) for names in filtered)
    assert table.current(spark).filter(F.col("symbol") == F.sha2(F.lit("7"), 256)).count() == 1


# -- counts ----------------------------------------------------------------------------------------------


def test_an_upsert_counts_on_the_way_and_reads_nothing_back(spark, trades, tmp_path):
    table, signals = signal_table(str(tmp_path / "s")), trading_signals(trades)
    counts = signals.agg(F.count(F.lit(1)), F.count_if(F.col("risk_level").isin("HIGH", "CRITICAL"))).first()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("upsert", "upsert")
    try:
        assert table.upsert(signals, 0) == {"rows": counts[0], "high_risk": counts[1]}
        jobs = tracker.getJobIdsForGroup("upsert")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # The shuffles and the write, each a job of its own; no stage scans what was written.
    stages = {tracker.getStageInfo(stage).name for job in jobs for stage in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(stage)}
    assert stages and not any(name.startswith(("count", "first", "collect")) for name in stages)


def test_empty_batches_count_nothing(spark, trades, tmp_path):
    table = bar_table(str(tmp_path / "b"))
    for number, rows in enumerate([
        ohlcv(trades).filter("false"), ohlcv(trades.filter("price < -5")), spark.createDataFrame([], schemas.BAR),
    ]):
        assert table.upsert(rows, number) == {"rows": 0}
    assert not glob.glob(f"{table.path}/delta/*/*")


# -- retention -------------------------------------------------------------------------------------------


def days_of(table):
    return sorted({folder.rsplit("=", 1)[1] for folder in glob.glob(f"{table.path}/*/*/*/{table.bucket}=*")
                   + glob.glob(f"{table.path}/base/*/{table.bucket}=*")})


def test_expiry_drops_days_unread_and_rewrites_only_the_border(spark, trades, tmp_path):
    table, rows = bar_table(str(tmp_path / "b")), ohlcv(trades)
    table.upsert(rows, 0)
    table.compact(spark)
    table.upsert(rows.filter("window_start < '2024-01-20 00:00:00'"), 1)
    kept_file = glob.glob(f"{table.path}/base/*/date_bucket=2024-01-25/*.parquet")
    old_file = glob.glob(f"{table.path}/base/*/date_bucket=2024-01-03/*.parquet")[0]
    with open(old_file, "wb") as broken:  # a day that goes whole is never opened
        broken.write(b"no parquet")
    done = table.expire(spark, 10, "2024-01-25 12:00:00")
    oldest = datetime.datetime(2024, 1, 15, 12)
    kept = rows.filter(F.col("window_start") >= F.lit(oldest))
    assert same(table.current(spark), kept) and min(days_of(table)) == "2024-01-15"
    assert done["folders"] > 14 and done["rows"] >= kept.filter("date_bucket = '2024-01-15'").count() > 0
    assert glob.glob(f"{table.path}/base/*/date_bucket=2024-01-25/*.parquet") == kept_file
    table.expire(spark, 10, "2024-01-25 12:00:00")
    assert same(table.current(spark), kept)
    table.upsert(rows, 1)  # a batch written again brings its rows back until the next run
    table.expire(spark, 10, "2024-01-25 12:00:00")
    assert same(table.current(spark), kept)


def test_a_cut_off_expiry_loses_nothing(spark, trades, tmp_path, monkeypatch):
    from candlewick.sinks import keyed

    table, rows = bar_table(str(tmp_path / "b")), ohlcv(trades)
    table.upsert(rows, 0)

    def stop(spark, folder):
        raise OSError("cut off")

    monkeypatch.setattr(keyed, "delete_folder", stop)
    with pytest.raises(OSError):
        table.expire(spark, 10, "2024-01-25 12:00:00")
    assert same(table.current(spark), rows)
    monkeypatch.undo()
    table.expire(spark, 10, "2024-01-25 12:00:00")
    assert same(table.current(spark), rows.filter("window_start >= '2024-01-15 12:00:00'"))


def test_the_newest_version_survives_expiry(spark, tmp_path):
    table = health_table(str(tmp_path / "h"))
    at = datetime.datetime(2024, 1, 8, 13)
    for number, rate in enumerate((1.0, 2.0, 3.0)):
        table.upsert(spark.createDataFrame([("producer", at, rate, 0.0, 1.0, "{}")], schemas.HEALTH), number)
    assert table.expire(spark, 7, "2024-01-15 12:30:00") == {"folders": 3, "rows": 3}
    assert [row["messages_per_sec"] for row in table.current(spark).collect()] == [3.0]
    assert table.expire(spark, 7, "2024-01-15 13:30:00") == {"folders": 1, "rows": 0}
    assert table.current(spark).isEmpty()


def test_expiry_of_an_empty_table(spark, tmp_path):
    assert bar_table(str(tmp_path / "b")).expire(spark, 1) == {"folders": 0, "rows": 0}


# -- views -----------------------------------------------------------------------------------------------


def test_latest_signals_merge_batch_by_batch(spark, trades, tmp_path):
    signals = trading_signals(trades)
    view = MergedView(str(tmp_path / "v"), schemas.LATEST_SIGNAL)
    assert view.current(spark).isEmpty()
    bounds = ["2024-01-01", "2024-01-09", "2024-01-17", "2024-01-25", "2024-02-25"]
    order = [2, 0, 3, 1]  # windows that come late change nothing
    for number, part in enumerate(order):
        batch = signals.filter(F.col("window_start").between(bounds[part], bounds[part + 1]))
        view.merge(spark, number, "job", lambda before, batch=batch: merged_latest(before, batch))
    assert same(view.current(spark), latest_signals(signals))
    assert view.current(spark).count() == signals.select("symbol").distinct().count()


def test_a_batch_that_is_run_again_starts_from_the_same_view(spark, tmp_path):
    view = MergedView(str(tmp_path / "v"), schemas.CLOSE)
    row = lambda close: spark.createDataFrame([("A", NOW, close)], schemas.CLOSE)
    seen = []

    def grow(before, close):
        seen.append(sorted(item["close"] for item in before.collect()))
        return before.unionByName(row(close))

    for number in (0, 1, 1, 2):
        view.merge(spark, number, "job", lambda before, number=number: grow(before, float(number)))
    assert seen == [[], [0.0], [0.0], [0.0, 1.0]]
    view.merge(spark, 0, "anew", lambda before: grow(before, 9.0))
    assert seen[-1] == [0.0, 1.0, 2.0], "a job begun anew goes on from the newest view"
    for number in range(3, 12):
        view.merge(spark, number, "job", lambda before, number=number: grow(before, float(number)))
    assert len(glob.glob(str(tmp_path / "v/writer=job/*"))) == 4


def test_late_signal_of_the_same_window_wins(spark, tmp_path):
    signal = lambda close: spark.createDataFrame(
        [("A", NOW.date(), NOW, close, close, 1.0, 1.0, 0.0, 1, False, 0.0, 1.0, "LOW", None)], schemas.SIGNAL
    )
    none = spark.createDataFrame([], schemas.LATEST_SIGNAL)
    once = merged_latest(none, signal(1.0))
    assert merged_latest(once, signal(2.0)).first()["close"] == 2.0
    assert merged_latest(once, signal(2.0).withColumn("window_start", F.lit(NOW - datetime.timedelta(1)))).first()["close"] == 1.0


# -- strength index --------------------------------------------------------------------------------------


@pytest.mark.parametrize("cuts", [["2024-01-05"], ["2024-01-02", "2024-01-03", "2024-01-11", "2024-01-11 06:00:00"]])
def test_index_in_batches_equals_one_run(spark, trades, cuts):
    bars = ohlcv(trades, "6 hours")
    carried, parts, start = spark.createDataFrame([], schemas.CLOSE), None, "2000-01-01"
    for end in [*cuts, "2100-01-01"]:
        batch = bars.filter((F.col("window_start") >= start) & (F.col("window_start") < end))
        found = rsi_after(batch, carried).select("symbol", "window_start", "close", "rsi_14")
        parts = found if parts is None else parts.unionByName(found)
        carried, start = last_closes(batch, carried), end
    assert same(parts, rsi(bars))


def test_no_more_closes_are_carried_than_an_index_needs(spark, trades):
    carried = last_closes(ohlcv(trades, "6 hours"), spark.createDataFrame([], schemas.CLOSE))
    assert carried.groupBy("symbol").count().agg(F.max("count")).first()[0] == 14


def test_index_reads_its_bars_once(spark, trades):
    text = plan(rsi(ohlcv(trades)), "simple")
    assert "events.parquet" not in text and text.count("FileScan") == 2  # of the stored closes: number and index


# -- panes -----------------------------------------------------------------------------------------------


def test_panes_hold_summaries(spark, trades):
    made = panes(summarise(trades, "5 minutes"))
    assert made.columns == schemas.PANE.names
    assert same(bars_of(summaries_of(made)), ohlcv(trades))


# -- Bronze zones ----------------------------------------------------------------------------------------


def stored_days(rows):
    return [trade(n, 10.0 + n, minute=day * 1440 + 5, date_partition=folder, symbol="BTC") for n, (day, folder) in enumerate(rows)]


def test_only_files_of_the_day_are_read_and_late_trades_are_found(spark, tmp_path):
    path = str(tmp_path / "b")
    for folder_day in range(1, 9):  # one file a day, the last also holds trades of the second day
        rows = [(folder_day - 1, f"2024/01/{folder_day:02d}")] + ([(1, "2024/01/08")] if folder_day == 8 else [])
        write_bronze(frame(spark, stored_days(rows)).drop("trade_timestamp").coalesce(1), path)
    chosen = read_days(spark, path, ["2024/01/02"])
    assert chosen.count() == 2
    assert len(chosen.inputFiles()) == 2 < len(read_bronze(spark, path).inputFiles()) == 8
    assert read_days(spark, path, ["2024/01/02"], ["ETH"]).isEmpty()
    assert read_days(spark, path, ["2030/01/01"]).isEmpty()
    assert read_days(spark, path, ["2024/01/04", "2024/01/03"]).count() == 2


def test_the_zone_map_grows_by_new_files_only(spark, tmp_path):
    path = str(tmp_path / "b")
    write_bronze(frame(spark, stored_days([(0, "2024/01/01"), (2, "2024/01/01")])).drop("trade_timestamp").coalesce(1), path)
    frame(spark, stored_days([(1, "2024/01/02")])).drop("trade_timestamp").write.mode("append").partitionBy(
        "date_partition", "symbol"
    ).parquet(path)  # a writer that keeps no map
    parts = lambda: len(glob.glob(f"{path}/_zones/*.parquet"))
    assert parts() == 1 and refresh_zones(spark, path).count() == 2 and parts() == 2
    assert refresh_zones(spark, path).agg(F.sum("trades")).first()[0] == 3 and parts() == 2
    for file in glob.glob(f"{path}/date_partition=2024%2F01%2F01/*/*.parquet"):
        os.remove(file)
    assert refresh_zones(spark, path).count() == 1
    assert read_bronze(spark, path).count() == 1


def test_symbols_and_folders_with_odd_names(spark, tmp_path):
    path = str(tmp_path / "b c+d%20")
    rows = [trade(1, 1.0, symbol="A+B C/D%2B"), trade(2, 2.0, symbol="é=1")]
    write_bronze(frame(spark, rows).drop("trade_timestamp"), path)
    assert {row["symbol"] for row in read_days(spark, path, ["2024/01/01"]).collect()} == {"A+B C/D%2B", "é=1"}


# -- health, repeats -------------------------------------------------------------------------------------


def test_the_seed_row_comes_once(spark, tmp_path):
    paths = JobPaths(str(tmp_path))
    for _ in range(2):
        seed_health(spark, paths, NOW)
    assert [tuple(row)[:2] for row in health_table(paths.health).current(spark).collect()] == [("system", NOW)]


def test_repeats_are_found_by_hash_alone(spark, trades):
    single = without_repeats(trades.unionByName(trades))
    text = plan(single, "simple")
    assert "Sort" not in text and "HashAggregate" in text
    assert single.columns == trades.columns
    assert sorted(map(tuple, single.collect())) == sorted(map(tuple, trades.collect()))
    assert without_repeats(trades.drop("date_partition")).columns == [name for name in trades.columns if name != "date_partition"]
