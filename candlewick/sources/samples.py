"""The given tables read as trade ticks and as raw trade messages."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from candlewick.operators.ingest import check, trade_columns, with_event_time
from candlewick.session import use_utc

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    use_utc(spark)
    if stream:
        return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parquet*")
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


# Deliveries of a replay: how many, how long a row may be under way and still count, and how far too late rows come.
DELIVERIES = 6
REPLAY_LATENESS = "6 hours"
_TARDY_MS = 5 * 3_600_000
_DELIVERIES_LATE = 3


def deliveries(source: DataFrame) -> DataFrame:
    """Events with the number of the delivery they arrive with: `delivery`, 0 to DELIVERIES - 1.

    The time span is cut evenly. Half of the events of a part's last five hours come one delivery later, which the watermark of
    REPLAY_LATENESS allows; one in 97 comes three deliveries later, days behind it.
    """
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    first, last = source.agg(F.min(millis), F.max(millis)).first()
    width = ((last or 0) - (first or 0)) // DELIVERIES + 1
    part, into = F.floor((millis - (first or 0)) / width), (millis - (first or 0)) % width
    late = (F.col("event_id") % 97 == 5) & (part + _DELIVERIES_LATE < DELIVERIES)
    tardy = (F.col("event_id") % 2 == 0) & (part + 1 < DELIVERIES) & (into >= width - _TARDY_MS)
    number = F.when(late, part + _DELIVERIES_LATE).when(tardy, part + 1).otherwise(part)
    return source.withColumn("delivery", number.cast("int"))


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def raw_messages(source: DataFrame, faulty: bool = False) -> DataFrame:
    """One JSON message per event, with the time it was received: (value, ingest_time_ms).

    `faulty` breaks some of the messages, chosen by event id, so that every check has rows to reject.
    """
    fault = F.col("event_id") % 101
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    price = F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))
    quantity = F.concat(F.lit('"'), F.get_json_object("props", "$.k"), F.lit('"'))
    trade_id, maker = F.col("event_id").cast("string"), (F.col("user_id") % 2 == 0).cast("string")
    trade_ms = millis.cast("string")
    if faulty:
        price = (
            F.when(fault == 2, '"abc"').when(fault == 3, "null").when(fault == 4, '"nan"')
            .when(fault == 5, '" 1e1 "').when(fault == 6, '"1_0"').otherwise(price)
        )
        quantity = F.when(fault == 7, '"-1"').when(fault == 8, "2").otherwise(quantity)
        trade_id = F.when(fault == 9, "null").otherwise(trade_id)
        trade_ms = F.when(fault == 10, '"soon"').otherwise(trade_ms)
        maker = F.when(fault == 11, "null").when(fault == 12, '"false"').otherwise(maker)
    body = F.concat(
        F.lit('{"e":"trade","E":'), millis.cast("string"),
        F.lit(',"s":"'), F.col("event_type"),
        F.lit('","t":'), trade_id,
        F.lit(',"p":'), price,
        F.lit(',"q":'), quantity,
        F.lit(',"T":'), trade_ms,
    )
    whole = F.concat(body, F.lit(',"m":'), maker, F.lit("}"))
    if faulty:
        whole = (
            F.when(fault == 0, body)
            .when(fault == 1, F.concat(body, F.lit("}")))
            .when(fault == 13, F.concat(whole, F.lit(" x")))
            .when(fault == 14, F.concat(F.lit("["), whole, F.lit("]")))
            .otherwise(whole)
        )
    return source.select(
        whole.alias("value"), (millis + F.col("event_id") * 37 % 500).alias("ingest_time_ms")
    )


def checked_messages(source: DataFrame, faulty: bool = False) -> DataFrame:
    return check(raw_messages(source, faulty), ingest_ms=F.col("ingest_time_ms"))


def trades(source: DataFrame, lateness: str | None = None) -> DataFrame:
    """Trades of the events, straight from their columns; equal to parsing `raw_messages`."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    ticks = source.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        millis.alias("trade_time_ms"),
        millis.alias("event_time_ms"),
        (millis + F.col("event_id") * 37 % 500).alias("ingest_time_ms"),
    ).filter((F.col("price") > 0) & (F.col("quantity") > 0))
    return with_event_time(ticks.select(*trade_columns()), lateness)


def line_item_trades(source: DataFrame) -> DataFrame:
    """Order lines as trades: two symbols with half of the rows each, and all trades of a day at one time."""
    millis = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    ticks = source.select(
        (line * 10_000_000 + F.col("l_partkey")).cast("string").alias("trade_id"),
        F.col("l_linestatus").alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_linenumber") % 2 == 0).alias("is_buyer_maker"),
        millis.alias("trade_time_ms"),
        millis.alias("event_time_ms"),
        (millis + F.col("l_orderkey") % 500).alias("ingest_time_ms"),
    )
    return with_event_time(ticks.select(*trade_columns()))
