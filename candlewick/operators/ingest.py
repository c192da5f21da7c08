"""Raw JSON messages -> checked messages -> trades and dead letters.

`check` reads each message once and adds one `error_reason`; NULL means accepted. Everything is a
column expression, so the same code serves batch and streaming frames.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from candlewick import settings
from candlewick.functions import day_path, event_time

# Number spellings the feed may use: sign, digits with single underscores, fraction, exponent, spaces. The
# digits match possessively, so a text of any length is read once and never backtracked.
_DIGITS = r"\d++(?:_\d++)*+"
_INTEGER = rf"^\s*[+-]?{_DIGITS}\s*$"
_REAL = rf"^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
_NON_FINITE = r"(?i)^\s*[+-]?(?:inf|infinity|nan)\s*$"

# Fields are read as text, which is all a well-formed message needs. Only where the text will not do are
# the JSON types and keys of that one message looked at. The keys differ only in case, so the fields are
# renamed by position right after parsing.
_FIELDS = ("kind", "event_ms", "symbol", "trade_id", "price", "quantity", "trade_ms", "maker")
_MESSAGE_TYPE = "array<struct<" + ",".join(f"{key}:string" for key in settings.REQUIRED_KEYS) + ">>"
_RENAMED_TYPE = "array<struct<" + ",".join(f"{name}:string" for name in _FIELDS) + ">>"

PARSE_ERROR = "JSON parse error"
MISSING = "Missing required fields"
CAST_ERROR = "Type cast error"
NON_FINITE = "Non-finite values"
NON_POSITIVE = "Non-positive values"
NULL_KEY = "Null key field"
IMPLAUSIBLE = "Implausible event time"


def wall_clock_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def _without_underscores(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def _typed_number(key: str, kind: str) -> Column:
    """The field as a number if its JSON type is number or boolean; NULL for a string."""
    field = F.try_variant_get(F.try_parse_json("raw_message"), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(field) != "STRING", F.try_variant_get(field, "$", kind))


def _real(text: Column, key: str) -> Column:
    return (
        F.when(text.rlike(_REAL), _without_underscores(text).try_cast("double"))
        .when(text.rlike(_NON_FINITE), F.lit(float("nan")))
        .when(text.isNotNull(), _typed_number(key, "double"))
    )


def _whole(text: Column, key: str) -> Column:
    return F.when(text.rlike(_INTEGER), _without_underscores(text).try_cast("bigint")).when(
        text.isNotNull(), _typed_number(key, "bigint")
    )


def _truth(text: Column) -> Column:
    """False for null, zero, 'false' and anything empty; true for the rest."""
    return F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0, ~text.isin("", "[]", "{}"), F.lit(False))


def _not_finite(number: Column) -> Column:
    return F.isnan(number) | (F.abs(number) == F.lit(float("inf")))


def _cast_reason(key: str, text: Column) -> Column:
    return F.concat(F.lit(f"{CAST_ERROR}: {key}="), F.coalesce(text, F.lit("null")))


def _absent_keys() -> Column:
    """Required keys the message lacks, sorted; a key with a null value is present."""
    required = F.array(*[F.lit(key) for key in sorted(settings.REQUIRED_KEYS)])
    return F.array_except(required, F.json_object_keys("raw_message"))


def _reason(message: Column, max_ahead_ms: int | None) -> Column:
    """The first failing check, in the order the checks are listed."""
    field = {key: message.getField(name) for key, name in zip(settings.REQUIRED_KEYS, _FIELDS)}
    any_empty = reduce(or_, [text.isNull() for text in field.values()])
    absent = _absent_keys()
    price, quantity = F.col("price"), F.col("quantity")
    return (
        F.when(message.isNull(), F.lit(PARSE_ERROR))
        .when(
            any_empty & (F.size(absent) > 0),
            F.concat(F.lit(f"{MISSING}: ['"), F.array_join(absent, "', '"), F.lit("']")),
        )
        .when(price.isNull(), _cast_reason("p", field["p"]))
        .when(quantity.isNull(), _cast_reason("q", field["q"]))
        .when(_not_finite(price) | _not_finite(quantity), _pair(NON_FINITE, price, quantity))
        .when((price <= 0) | (quantity <= 0), _pair(NON_POSITIVE, price, quantity))
        .when(F.col("trade_id").isNull(), F.lit(f"{NULL_KEY}: t"))
        .when(F.col("symbol").isNull(), F.lit(f"{NULL_KEY}: s"))
        .when(F.col("trade_time_ms").isNull(), _cast_reason("T", field["T"]))
        .when(F.col("event_time_ms").isNull(), _cast_reason("E", field["E"]))
        .when(_too_far_ahead(max_ahead_ms), F.concat(F.lit(f"{IMPLAUSIBLE}: T="), F.col("trade_time_ms").cast("string")))
    )


def _too_far_ahead(max_ahead_ms: int | None) -> Column:
    """A trade said to happen so much later than it was received; a far-off time that would overflow counts too."""
    if max_ahead_ms is None:
        return F.lit(False)
    ahead = F.try_subtract("trade_time_ms", "ingest_time_ms")
    return F.coalesce(ahead > max_ahead_ms, F.col("trade_time_ms") > F.col("ingest_time_ms"))


def _pair(label: str, price: Column, quantity: Column) -> Column:
    return F.concat(
        F.lit(f"{label}: price="), price.cast("string"), F.lit(", qty="), quantity.cast("string")
    )


def _parse(value: Column) -> Column:
    """One JSON object as a struct of texts, in an array; NULL or another length for anything else.

    Parsing inside brackets makes trailing text an error, which the plain parser would ignore.
    """
    wrapped = F.concat(F.lit("["), value, F.lit("]"))
    return F.from_json(wrapped, _MESSAGE_TYPE, {"allowSingleQuotes": "false"}).cast(_RENAMED_TYPE)


def check(
    raw: DataFrame, ingest_ms: Column | None = None, value: str = "value", max_ahead_ms: int | None = None
) -> DataFrame:
    """Add the typed trade fields and `error_reason` to raw messages.

    With `max_ahead_ms`, a trade time further ahead of the time of receipt is an error: let through, a single one
    would move the watermark of every live job and make all later trades late.

    Result: raw_message, ingest_time_ms, trade_id, symbol, price, quantity, is_buyer_maker,
    trade_time_ms, event_time_ms, error_reason. One row out per row in.
    """
    parsed = raw.select(
        F.col(value).cast("string").alias("raw_message"),
        (wall_clock_ms() if ingest_ms is None else ingest_ms).alias("ingest_time_ms"),
        _parse(F.col(value).cast("string")).alias("parsed"),
    )
    single = (F.size("parsed") == 1) & F.endswith(F.rtrim("raw_message", F.lit(" \t\r\n")), F.lit("}"))
    message = parsed.select(
        "raw_message", "ingest_time_ms", F.when(single, F.get("parsed", F.lit(0))).alias("message")
    )
    text = F.col("message")
    typed = message.select(
        "*",
        text.trade_id.alias("trade_id"),
        F.upper(text.symbol).alias("symbol"),
        _real(text.price, "p").alias("price"),
        _real(text.quantity, "q").alias("quantity"),
        _truth(text.maker).alias("is_buyer_maker"),
        _whole(text.trade_ms, "T").alias("trade_time_ms"),
        _whole(text.event_ms, "E").alias("event_time_ms"),
    )
    checked = typed.select("*", _reason(text, max_ahead_ms).alias("error_reason")).drop("message")
    # The generator is a fence: a later filter on error_reason stays above it instead of repeating the
    # parsing and all checks below.
    return checked.select(F.explode(F.array(F.struct(*checked.columns))).alias("checked")).select("checked.*")


def accepted(checked: DataFrame) -> DataFrame:
    """The trades of the messages that passed."""
    return checked.filter(F.col("error_reason").isNull()).select(*trade_columns())


def rejected(checked: DataFrame) -> DataFrame:
    """The dead letters of the messages that failed."""
    return checked.filter(F.col("error_reason").isNotNull()).select(
        "raw_message", "error_reason", F.col("ingest_time_ms").alias("received_at")
    )


def route(raw: DataFrame, ingest_ms: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(trades, dead letters). Writing both reads the input twice; `topic_rows` does it in one pass."""
    checked = check(raw, ingest_ms)
    return accepted(checked), rejected(checked)


def topic_rows(
    checked: DataFrame,
    trades_topic: str = settings.TRADES_TOPIC,
    dead_letter_topic: str = settings.DEAD_LETTER_TOPIC,
) -> DataFrame:
    """Every message once, as (topic, key, value): trades keyed by id, dead letters by a constant."""
    failed = F.col("error_reason").isNotNull()
    dead_letter = F.struct("raw_message", "error_reason", F.col("ingest_time_ms").alias("received_at"))
    return checked.select(
        F.when(failed, F.lit(dead_letter_topic)).otherwise(F.lit(trades_topic)).alias("topic"),
        F.when(failed, F.lit(settings.DEAD_LETTER_KEY)).otherwise(F.col("trade_id")).alias("key"),
        F.when(failed, F.to_json(dead_letter)).otherwise(F.to_json(F.struct(*trade_columns()))).alias("value"),
    )


def trade_columns() -> list[Column]:
    """The topic payload, with the derived notional, latency and ingest day."""
    return [
        F.col("trade_id"),
        F.col("symbol"),
        F.col("price"),
        F.col("quantity"),
        F.col("is_buyer_maker"),
        F.col("trade_time_ms"),
        F.col("event_time_ms"),
        F.col("ingest_time_ms"),
        F.round(F.col("price") * F.col("quantity"), 4).alias("notional_usd"),
        latency_ms().alias("latency_ms"),
        day_path(F.col("ingest_time_ms")).alias("date_partition"),
    ]


def latency_ms() -> Column:
    """Milliseconds from trade to ingest; NULL where a far-off trade time would overflow."""
    return F.try_subtract("ingest_time_ms", "trade_time_ms")


def with_event_time(trades: DataFrame, lateness: str | None = None) -> DataFrame:
    """Add `trade_timestamp`; with `lateness`, also the watermark on it."""
    timed = trades.withColumn("trade_timestamp", event_time(F.col("trade_time_ms")))
    return timed.withWatermark("trade_timestamp", lateness) if lateness else timed


def without_repeats(trades: DataFrame) -> DataFrame:
    """Drop repeated deliveries of a trade.

    A stream forgets an id once the watermark has passed it; a batch compares all rows. The ingest day of a batch
    is made anew: without texts beside the key, rows are compared by hash and not sorted.
    """
    key = ["symbol", "trade_id"]
    if trades.isStreaming:
        return trades.dropDuplicatesWithinWatermark(key)
    if not {"date_partition", "ingest_time_ms"} <= set(trades.columns):
        return trades.dropDuplicates(key)
    single = trades.drop("date_partition").dropDuplicates(key)
    return single.withColumn("date_partition", day_path(F.col("ingest_time_ms"))).select(*trades.columns)
