"""Buy/sell pressure, deviation, risk level and alert text per symbol and window."""

from pyspark.sql import Column, DataFrame, functions as F

from candlewick import settings
from candlewick.functions import ratio, round_sum, utc_date, window_label
from candlewick.operators.summaries import mean_price, summarise


def side_volumes(summaries: DataFrame, window: str = settings.GOLD_WINDOW) -> DataFrame:
    """Close, mean price and volumes by side. A trade of unknown side counts in neither side."""
    label = window_label(window)
    return summaries.select(
        "symbol",
        utc_date(F.col("span.start")).alias("date_bucket"),
        F.col("span.start").alias("window_start"),
        "close",
        mean_price().alias(f"sma_{label}"),
        F.col("volume").alias(f"volume_{label}"),
        "buy_volume",
        "sell_volume",
        "trade_count",
    )


def _risk_level(spike: Column, deviation: Column) -> Column:
    """The thresholds see the rounded deviation; a NULL deviation leaves the spike to decide."""
    far = deviation > settings.DEVIATION_HIGH_PCT
    return (
        F.when(spike & far, "CRITICAL")
        .when(spike | far, "HIGH")
        .when(deviation > settings.DEVIATION_MEDIUM_PCT, "MEDIUM")
        .otherwise("LOW")
    )


def _alert_message(level: Column, deviation: Column) -> Column:
    shown = deviation.cast("string")
    critical = F.concat_ws(
        " | ",
        F.lit(settings.CRITICAL_HEADLINE),
        F.concat(F.lit("Price dev: "), shown, F.lit("%")),
        F.lit(settings.DUMP_NOTE),
    )
    high = F.concat(F.lit(settings.HIGH_HEADLINE), shown, F.lit("%"))
    return F.when(level == "CRITICAL", critical).when(level == "HIGH", high)


def grade(base: DataFrame, mean: str) -> DataFrame:
    """Add volume_spike, price_deviation_pct, buy_pressure, risk_level and alert_message."""
    buy, sell = F.col("buy_volume"), F.col("sell_volume")
    spike = F.coalesce(sell > buy * settings.SPIKE_RATIO, F.lit(False))
    deviation = ratio(F.abs(F.col("close") - F.col(mean)), F.col(mean)) * 100
    measured = base.select(
        "*",
        spike.alias("volume_spike"),
        round_sum(deviation, 4).alias("price_deviation_pct"),
        round_sum(ratio(buy, buy + sell), 4).alias("buy_pressure"),
    )
    level = _risk_level(F.col("volume_spike"), F.col("price_deviation_pct"))
    return measured.select(
        "*",
        level.alias("risk_level"),
        _alert_message(level, F.col("price_deviation_pct")).alias("alert_message"),
    )


def trading_signals(
    trades: DataFrame, window: str = settings.GOLD_WINDOW, order: Column | None = None
) -> DataFrame:
    return signals_of(summarise(trades, window, order=order), window)


def signals_of(summaries: DataFrame, window: str = settings.GOLD_WINDOW) -> DataFrame:
    return grade(side_volumes(summaries, window), f"sma_{window_label(window)}")


def high_risk(signals: DataFrame) -> DataFrame:
    return signals.filter(F.col("risk_level").isin(*settings.HIGH_RISK))


def alert_history(signals: DataFrame, window: str = settings.GOLD_WINDOW) -> DataFrame:
    """One alert per high-risk signal, timed at the end of its window and not yet notified."""
    return high_risk(signals).select(
        "symbol",
        "risk_level",
        (F.col("window_start") + F.expr(f"interval {window}")).alias("alert_time"),
        "window_start",
        F.col("close").alias("price"),
        F.col(f"volume_{window_label(window)}").alias("volume"),
        F.col("price_deviation_pct").alias("deviation_pct"),
        "buy_pressure",
        "alert_message",
        F.lit(False).alias("notified"),
    )
