"""Operational measures over checked messages, topic rows, trades and dead letters."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick import schemas, settings
from candlewick.functions import event_time, ratio, trade_order, window_seconds
from candlewick.operators.ingest import latency_ms
from candlewick.operators.tables import as_instant

_FIRST_METRIC = "component string, messages_per_sec double, error_rate double, avg_latency_ms double, extra_json string"


def message_counts(topic_rows: DataFrame) -> DataFrame:
    return topic_rows.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def dead_letter_counts(dead_letters: DataFrame) -> DataFrame:
    """Dead letters per reason, without the values the reason quotes."""
    return dead_letters.groupBy(
        F.substring_index("error_reason", ":", 1).alias("error_class")
    ).agg(F.count(F.lit(1)).alias("dead_letters"))


def last_trade(trades: DataFrame) -> DataFrame:
    """Trade time of the trade received last, per symbol."""
    received = trade_order("ingest_time_ms", "trade_id")
    return (
        trades.withColumn("received", received)
        .groupBy("symbol")
        .agg(F.max_by("trade_time_ms", "received").alias("last_trade_time_ms"))
    )


def latency_histogram(trades: DataFrame, bounds: tuple[int, ...] = settings.LATENCY_BUCKETS_MS) -> DataFrame:
    """Cumulative counts per upper bound `le`, the last one without bound; one pass, one row shuffled per task."""
    latency = F.col("latency_ms")
    counts = trades.agg(
        *[F.count_if(latency <= bound).alias(f"le_{bound}") for bound in bounds],
        F.count(latency).alias("le_inf"),
    )
    rows = [F.struct(F.lit(str(bound)).alias("le"), F.col(f"le_{bound}").alias("observations")) for bound in bounds]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("le_inf").alias("observations")))
    return counts.select(F.inline(F.array(*rows)))


def high_risk_count(signals: DataFrame) -> DataFrame:
    return signals.agg(
        F.count(F.lit(1)).alias("signals"),
        F.count_if(F.col("risk_level").isin(*settings.HIGH_RISK)).alias("high_risk"),
    )


def first_metric(spark: SparkSession, as_of: datetime | str) -> DataFrame:
    """The one row a new health table starts with."""
    row = spark.createDataFrame([("system", 0.0, 0.0, 0.0, '{"status": "initialized"}')], _FIRST_METRIC)
    return row.withColumn("metric_time", as_instant(as_of)).select(*schemas.HEALTH.names)


def with_ingest_time(checked: DataFrame, lateness: str | None = None) -> DataFrame:
    timed = checked.withColumn("ingest_time", event_time(F.col("ingest_time_ms")))
    return timed.withWatermark("ingest_time", lateness) if lateness else timed


def component_health(timed: DataFrame, component: str = "producer", every: str = "1 minute") -> DataFrame:
    """Rate, error share and mean latency of checked messages per interval of `ingest_time`.

    A metric is timed at the end of its interval.
    """
    failed = F.col("error_reason").isNotNull()
    latency = F.when(~failed, latency_ms())
    grouped = timed.groupBy(F.window("ingest_time", every).alias("span")).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(failed).alias("dead_letters"),
        F.avg(latency).alias("latency"),
    )
    accepted = F.col("received") - F.col("dead_letters")
    return grouped.select(
        F.lit(component).alias("component"),
        F.col("span.end").alias("metric_time"),
        F.round(F.col("received") / F.lit(float(window_seconds(every))), 4).alias("messages_per_sec"),
        F.round(ratio(F.col("dead_letters"), F.col("received")), 4).alias("error_rate"),
        F.round("latency", 1).alias("avg_latency_ms"),
        F.to_json(F.struct(accepted.alias("accepted"), "dead_letters")).alias("extra_json"),
    )
