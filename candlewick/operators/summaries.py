"""What bars and signals need to know about the trades of a symbol and window, in a form that adds up.

Bars and signals only use some of the columns; Catalyst drops the aggregates nobody asks for.
"""

from pyspark.sql import Column, DataFrame, functions as F

from candlewick import schemas
from candlewick.functions import ratio, trade_order, utc_date

_EDGES = ("open", "open_at", "close", "close_at", "high", "low")

# Measures that need a column a narrow trade frame may lack.
_NEEDS = {
    "notional": "notional_usd",
    "latency_sum": "latency_ms",
    "latency_count": "latency_ms",
    "buy_volume": "is_buyer_maker",
    "sell_volume": "is_buyer_maker",
}


def summarise(trades: DataFrame, window: str, slide: str | None = None, order: Column | None = None) -> DataFrame:
    """One row per symbol and `span`, from trades with `trade_timestamp`.

    First and last price follow trade time, then trade id (see `trade_order`), so neither arrival order
    nor partitioning changes them. A feed whose ids already rise with time may pass that id as `order`.
    Every aggregate combines on the map side: one row per (symbol, span) and task is shuffled, however
    many trades a symbol has. Measures whose column the trades lack are left out.
    """
    position = trade_order() if order is None else order
    span = F.window("trade_timestamp", window, slide) if slide else F.window("trade_timestamp", window)
    price, quantity, maker = F.col("price"), F.col("quantity"), F.col("is_buyer_maker")
    latency = F.col("latency_ms").cast("double")
    measures = {
        "open": F.min_by(price, "position"),
        "open_at": F.min("position"),
        "close": F.max_by(price, "position"),
        "close_at": F.max("position"),
        "high": F.max(price),
        "low": F.min(price),
        "price_sum": F.sum(price),
        "price_count": F.count(price),
        "turnover": F.sum(price * quantity),
        "volume": F.sum(quantity),
        "notional": F.sum("notional_usd"),
        "latency_sum": F.sum(latency),
        "latency_count": F.count(latency),
        "buy_volume": F.sum(F.when(~maker, quantity).otherwise(0.0)),
        "sell_volume": F.sum(F.when(maker, quantity).otherwise(0.0)),
        "trade_count": F.count(F.lit(1)),
    }
    known = [name for name in measures if _NEEDS.get(name, "symbol") in trades.columns]
    grouped = trades.withColumn("position", position).groupBy("symbol", span.alias("span"))
    return grouped.agg(*[measures[name].alias(name) for name in known])


def merge(summaries: DataFrame, window: str, slide: str | None = None) -> DataFrame:
    """Summaries of longer windows from those of tumbling ones that divide them (and `slide`)."""
    whole = F.window("span.start", window, slide) if slide else F.window("span.start", window)
    return summaries.groupBy("symbol", whole.alias("whole")).agg(
        F.min_by("open", "open_at").alias("open"),
        F.min("open_at").alias("open_at"),
        F.max_by("close", "close_at").alias("close"),
        F.max("close_at").alias("close_at"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        *[F.sum(name).alias(name) for name in summaries.columns if name not in ("symbol", "span", *_EDGES)],
    ).withColumnRenamed("whole", "span")


def panes(summaries: DataFrame) -> DataFrame:
    """Summaries in the columns a table of panes keeps."""
    span = F.col("span")
    named = summaries.withColumns({
        "date_bucket": utc_date(span["start"]), "window_start": span["start"], "window_end": span["end"],
    })
    return named.select(*schemas.PANE.names)


def summaries_of(panes: DataFrame) -> DataFrame:
    """The other way round."""
    span = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("span")
    return panes.select(span, *[name for name in panes.columns if name not in ("date_bucket", "window_start", "window_end")])


def mean_price() -> Column:
    return ratio(F.col("price_sum"), F.col("price_count"))


def mean_latency() -> Column:
    return ratio(F.col("latency_sum"), F.col("latency_count"))
