"""Writers of topic rows (topic, key, value)."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from candlewick import settings
from candlewick.operators.ingest import topic_rows


def write_topics(
    rows: DataFrame,
    kind: str = "kafka",
    *,
    servers: str | None = None,
    path: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """Write rows to the topic each names; delivery is at least once on a broker.

    One pass over the input feeds all topics. "files" keeps one folder per topic under `path`, which
    `topic_folder` names. A stream needs `checkpoint` and returns its query.
    """
    if kind not in ("kafka", "files"):
        raise ValueError(f"unknown topic kind: {kind}")
    writer = rows.writeStream if rows.isStreaming else rows.write
    if kind == "kafka":
        writer = (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all")
            .option("kafka.retries", "5")
            .option("kafka.compression.type", "gzip")
        )
    else:
        writer = writer.format("parquet").option("path", path).partitionBy("topic")
    if rows.isStreaming:
        writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
        return writer.trigger(**(trigger or {"processingTime": settings.BRONZE_TRIGGER})).start()
    writer.mode("append").save()
    return None


def topic_folder(path: str, topic: str) -> str:
    return f"{path}/topic={topic}"


def write_checked(checked: DataFrame, **target) -> StreamingQuery | None:
    """Trades and dead letters of checked messages, each to its topic, in one pass."""
    return write_topics(topic_rows(checked), **target)


def write_dead_letters(checked: DataFrame, **target) -> StreamingQuery | None:
    """Only the dead letters."""
    return write_topics(topic_rows(checked.filter("error_reason IS NOT NULL")), **target)
