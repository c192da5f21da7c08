"""Topics: streams of (key, value) rows, on a broker or as files in a folder."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from candlewick import schemas


def read_topic(
    spark: SparkSession,
    kind: str = "kafka",
    *,
    topic: str | None = None,
    servers: str | None = None,
    path: str | None = None,
    starting_offsets: str = "latest",
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Stream of (key, value) text.

    kind "kafka" subscribes to `topic` on `servers` (needs the Kafka connector on the cluster); kind "files"
    follows the Parquet files of `path`. `max_per_trigger` limits offsets or files per batch. Offsets
    that the broker has lost fail the query, unless `fail_on_data_loss` is false: then they are skipped.
    """
    if kind == "kafka":
        stream = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
        )
        if max_per_trigger:
            stream = stream.option("maxOffsetsPerTrigger", max_per_trigger)
        messages = stream.load()
        return messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
    if kind == "files":
        stream = spark.readStream.schema(schemas.TOPIC)
        if max_per_trigger:
            stream = stream.option("maxFilesPerTrigger", max_per_trigger)
        return stream.parquet(path)
    raise ValueError(f"unknown topic kind: {kind}")


def decode_trades(topic: DataFrame, schema: T.StructType = schemas.TRADE) -> DataFrame:
    """Payload -> trade columns. An unreadable payload or field becomes NULL, the row is kept.

    Pass a narrower schema when a sink needs few columns: the JSON parser then skips the rest.
    """
    payload = F.from_json(F.col("value").cast("string"), schema)
    return topic.select(payload.alias("data")).select("data.*")


def read_raw_messages(
    spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None
) -> DataFrame:
    """Raw feed: one JSON message per line, in a `value` column."""
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)
