"""The live jobs: each starts one streaming query with its own checkpoint and returns it."""

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from candlewick import schemas, settings
from candlewick.operators.bars import bars_of, ohlcv
from candlewick.operators.health import component_health, first_metric, with_ingest_time
from candlewick.operators.indicators import last_closes, rsi_after
from candlewick.operators.ingest import with_event_time
from candlewick.operators.signals import alert_history, trading_signals
from candlewick.operators.summaries import merge, panes, summaries_of, summarise
from candlewick.operators.tables import merged_latest
from candlewick.sinks.bronze import write_bronze
from candlewick.sinks.keyed import (
    KeyedTable, alert_table, bar_table, health_table, pane_table, rsi_table, signal_table,
)
from candlewick.sinks.views import MergedView
from candlewick.sources.topic import decode_trades, read_topic


@dataclass
class JobPaths:
    """Folders of the live tables; on a cluster all of them belong on shared storage."""

    root: str
    checkpoints: str = ""
    bronze: str = field(init=False)
    bars: str = field(init=False)
    signals: str = field(init=False)
    alerts: str = field(init=False)
    health: str = field(init=False)
    panes: str = field(init=False)
    latest: str = field(init=False)
    rsi: str = field(init=False)
    closes: str = field(init=False)

    def __post_init__(self):
        self.checkpoints = self.checkpoints or f"{self.root}/checkpoints"
        for name in ("bronze", "bars", "signals", "alerts", "health", "panes", "latest", "rsi", "closes"):
            setattr(self, name, f"{self.root}/{name}")

    def checkpoint(self, job: str) -> str:
        return f"{self.checkpoints}/{job}"


def live_trades(
    spark: SparkSession, schema: T.StructType = schemas.TRADE, lateness: str = settings.LATENESS, **source
) -> DataFrame:
    """Decoded trades of a topic, with event time and watermark; `source` goes to `read_topic`."""
    return with_event_time(decode_trades(read_topic(spark, **source), schema), lateness)


def start_bronze(
    trades: DataFrame, paths: JobPaths, trigger: dict | None = None,
    tasks_per_folder: int | None = settings.BRONZE_TASKS_PER_FOLDER,
) -> StreamingQuery:
    """Every trade, however late; a batch leaves at most so many files in the folder of a day and symbol."""
    plain = trades.drop("trade_timestamp")
    return write_bronze(plain, paths.bronze, paths.checkpoint("bronze"), trigger, tasks_per_folder)


def _writer(batch: DataFrame) -> str:
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def start_upsert(
    rows: DataFrame, table: KeyedTable, checkpoint: str, trigger: dict | None = None, also=None
) -> StreamingQuery:
    """Follow changed rows into a keyed table. Each of `also` (batch, batch_id, writer) runs after each write.

    The query's id names the writer: it belongs to the checkpoint, so a restarted job replaces the batch it
    repeats, while a job begun anew, with batch ids from 0 again, overwrites nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = _writer(batch)
        if not also:
            table.upsert(batch, batch_id, writer)
            return
        # Several outputs from one stateful batch: keep it, or the state would be read again for each.
        kept = batch.persist()
        try:
            table.upsert(kept, batch_id, writer)
            for follow in also:
                follow(kept, batch_id, writer)
        finally:
            kept.unpersist()

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": settings.SILVER_TRIGGER}))
        .outputMode("update")
        .start()
    )


def start_silver(trades: DataFrame, paths: JobPaths, trigger: dict | None = None) -> StreamingQuery:
    """Five-minute bars, each rewritten until the watermark closes it."""
    return start_upsert(ohlcv(trades), bar_table(paths.bars), paths.checkpoint("silver"), trigger)


def start_panes(
    trades: DataFrame, paths: JobPaths, trigger: dict | None = None, slide: str = settings.SILVER_SLIDE
) -> StreamingQuery:
    """Summaries of each slide, from which `sliding_bars` makes windows: one row of state for a symbol and slide."""
    rows = panes(summarise(trades, slide))
    return start_upsert(rows, pane_table(paths.panes), paths.checkpoint("panes"), trigger)


def sliding_bars(
    spark: SparkSession, paths: JobPaths, window: str = settings.SILVER_WINDOW, slide: str = settings.SILVER_SLIDE,
    since: datetime | str | None = None, until: datetime | str | None = None,
) -> DataFrame:
    """Bars of sliding windows, merged from the panes when they are read.

    `since` and `until` choose panes by their start, so windows that reach over these ends hold less than they should.
    """
    kept = pane_table(paths.panes).current(spark, since, until)
    return bars_of(merge(summaries_of(kept), window, slide), window)


def start_gold(
    trades: DataFrame, paths: JobPaths, trigger: dict | None = None, alerts: bool = False, latest: bool = False
) -> StreamingQuery:
    """Fifteen-minute signals; with `alerts`, the high-risk ones also go to the alert history; with `latest`, the
    view of each symbol's newest signal follows, a row per symbol and batch instead of a look at all signals.
    """
    also = []
    if alerts:
        history = alert_table(paths.alerts)
        also.append(lambda batch, batch_id, writer: history.upsert(alert_history(batch), batch_id, writer))
    if latest:
        view = latest_view(paths.latest)
        also.append(lambda batch, batch_id, writer: view.merge(
            batch.sparkSession, batch_id, writer, lambda before: merged_latest(before, batch)
        ))
    signals = trading_signals(trades)
    return start_upsert(
        signals,
        signal_table(paths.signals),
        paths.checkpoint("gold"),
        trigger or {"processingTime": settings.GOLD_TRIGGER},
        also,
    )


def latest_view(path: str) -> MergedView:
    return MergedView(path, schemas.LATEST_SIGNAL)


def start_rsi(trades: DataFrame, paths: JobPaths, trigger: dict | None = None) -> StreamingQuery:
    """The index of five-minute bars as soon as the watermark closes them; each symbol's last closes go from batch to batch."""
    table, carry = rsi_table(paths.rsi), MergedView(paths.closes, schemas.CLOSE)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, writer = batch.sparkSession, _writer(batch)
        kept = batch.select("symbol", "window_start", "close").persist()
        try:
            table.upsert(rsi_after(kept, carry.before(spark, batch_id, writer)), batch_id, writer)
            carry.merge(spark, batch_id, writer, lambda before: last_closes(kept, before))
        finally:
            kept.unpersist()

    return (
        ohlcv(trades).writeStream.foreachBatch(write)
        .option("checkpointLocation", paths.checkpoint("rsi"))
        .trigger(**(trigger or {"processingTime": settings.SILVER_TRIGGER}))
        .outputMode("append")
        .start()
    )


def start_health(
    checked: DataFrame, paths: JobPaths, trigger: dict | None = None, component: str = "producer"
) -> StreamingQuery:
    """Per-minute health of checked messages; each of several jobs on one table needs a component name of its own."""
    timed = with_ingest_time(checked, settings.LATENESS)
    name = "health" if component == "producer" else f"health-{component}"
    return start_upsert(component_health(timed, component), health_table(paths.health), paths.checkpoint(name), trigger)


def seed_health(spark: SparkSession, paths: JobPaths, as_of: datetime | str | None = None) -> None:
    """The one row a new health table starts with; a table with rows stays as it is."""
    table = health_table(paths.health)
    if table.versions(spark).isEmpty():
        table.upsert(first_metric(spark, as_of), 0, "seed")


def start_all(
    spark: SparkSession, paths: JobPaths, trigger: dict | None = None, alerts: bool = False, latest: bool = False, **source
) -> list[StreamingQuery]:
    """Bronze, silver and gold of a topic; `source` goes to `read_topic`.

    Each query reads the topic itself, decoding only the fields it needs, and fails or lags alone.
    """
    return [
        start_bronze(live_trades(spark, **source), paths, trigger),
        start_silver(live_trades(spark, schemas.SILVER_INPUT, **source), paths, trigger),
        start_gold(live_trades(spark, schemas.GOLD_INPUT, **source), paths, trigger, alerts, latest),
    ]


def await_any(spark: SparkSession) -> None:
    """Block until one query ends; its error, if any, is raised here."""
    spark.streams.awaitAnyTermination()
