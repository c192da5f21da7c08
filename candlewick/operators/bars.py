"""Windowed open/high/low/close bars."""

from pyspark.sql import Column, DataFrame, functions as F

from candlewick import settings
from candlewick.functions import ratio, round_sum, utc_date, window_label, window_seconds
from candlewick.operators.summaries import mean_latency, mean_price, merge, summarise


def ohlcv(
    trades: DataFrame,
    window: str = settings.SILVER_WINDOW,
    slide: str | None = None,
    order: Column | None = None,
) -> DataFrame:
    """Bars per symbol and window. With `slide`, a trade counts in every window covering it.

    A batch with a `slide` that divides the window first sums up each slide and then merges those few
    rows, instead of copying every trade into every window. A stream cannot chain the two steps.
    """
    if slide and not trades.isStreaming and window_seconds(window) % window_seconds(slide) == 0:
        return bars_of(merge(summarise(trades, slide, order=order), window, slide), window)
    return bars_of(summarise(trades, window, slide, order), window)


def bars_of(summaries: DataFrame, window: str = settings.SILVER_WINDOW) -> DataFrame:
    return summaries.select(
        "symbol",
        utc_date(F.col("span.start")).alias("date_bucket"),
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        "open",
        "high",
        "low",
        "close",
        round_sum(mean_price(), 2).alias(f"sma_{window_label(window)}"),
        round_sum(ratio(F.col("turnover"), F.col("volume")), 2).alias("vwap"),
        round_sum(F.col("volume"), 6).alias("total_volume"),
        round_sum(F.col("notional"), 2).alias("total_notional_usd"),
        "trade_count",
        F.round(mean_latency(), 1).alias("avg_latency_ms"),
    )
