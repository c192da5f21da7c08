"""Trades stored as Parquet by ingest day and symbol."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from candlewick import settings
from candlewick.sinks.layout import gather
from candlewick.sources.bronze import refresh_zones

FOLDERS = ("date_partition", "symbol")
_TASKS_PER_FOLDER = 64


def write_bronze(
    trades: DataFrame,
    path: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    tasks_per_folder: int | None = None,
) -> StreamingQuery | None:
    """Append trades; a stream needs `checkpoint` and returns its query.

    A batch is gathered by folder, so neither tiny files nor one huge task come out, and its files are entered in the
    zone map (see `sources.bronze`). A stream writes the folders each task meets, without a shuffle; with
    `tasks_per_folder`, it gathers each folder's rows into at most that many tasks and files per batch.
    """
    if not trades.isStreaming:
        rows = gather(trades, FOLDERS, ["trade_id"], tasks_per_folder or _TASKS_PER_FOLDER)
        rows.write.mode("append").partitionBy(*FOLDERS).parquet(path)
        refresh_zones(trades.sparkSession, path)
        return None
    if tasks_per_folder:
        trades = gather(trades, FOLDERS, ["trade_id"], tasks_per_folder)
    return (
        trades.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*FOLDERS)
        .trigger(**(trigger or {"processingTime": settings.BRONZE_TRIGGER}))
        .outputMode("append")
        .start()
    )
