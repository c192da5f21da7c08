"""Bars, signals and alerts of stored trades from one scan of them."""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from candlewick import settings
from candlewick.functions import day_ranges
from candlewick.operators.bars import bars_of
from candlewick.operators.signals import alert_history, signals_of
from candlewick.operators.summaries import merge, summarise
from candlewick.sinks.keyed import alert_table, bar_table, delete_folder, signal_table
from candlewick.streaming.jobs import JobPaths


def stored_summaries(trades: DataFrame, folder: str, window: str = settings.SILVER_WINDOW) -> DataFrame:
    """Summaries, written once to a folder on shared storage and read back.

    Whatever is derived from them reads this small table, not the trades, and a lost executor costs a
    re-read of it instead of another scan.
    """
    rows = summarise(trades, window)
    rows.write.mode("overwrite").parquet(folder)
    return trades.sparkSession.read.schema(rows.schema).parquet(folder)


def on_days(trades: DataFrame, days: Sequence[str]) -> DataFrame:
    """The trades of some UTC days ('yyyy/MM/dd') by trade time, wherever they are stored.

    Late, replayed or misdated trades may be in the folder of any ingest day, so no folder is left out; `read_days`
    brings only the files that can hold some of them.
    """
    at, chosen = F.col("trade_time_ms"), F.lit(False)
    for start, end in day_ranges(days):
        chosen = chosen | ((at >= start) & (at < end))
    return trades.filter(chosen)


def backfill(
    trades: DataFrame, paths: JobPaths, name: str = "backfill", days: Sequence[str] | None = None
) -> dict[str, dict[str, int]]:
    """Upsert the bars, signals and alerts of `trades`; returns the counts per table.

    With `days` ('yyyy/MM/dd', by trade time), only windows of these days are written. They replace what is there, so
    `trades` must be all that are stored, of every ingest day. The same `name` again replaces what it wrote before.
    The summaries all three come from lie below the tables meanwhile and are deleted at the end.
    """
    folder = f"{paths.root}/staging/{name}-{uuid.uuid4().hex}"
    summaries = stored_summaries(trades if days is None else on_days(trades, days), folder)
    signals = signals_of(merge(summaries, settings.GOLD_WINDOW))
    try:
        return {
            "bars": bar_table(paths.bars).upsert(bars_of(summaries), 0, name),
            "signals": signal_table(paths.signals).upsert(signals, 0, name),
            "alerts": alert_table(paths.alerts).upsert(alert_history(signals), 0, name),
        }
    finally:
        delete_folder(trades.sparkSession, folder)
