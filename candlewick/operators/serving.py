"""Dashboard reads over the bar, signal and health tables, as of now or of a given moment."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.functions import utc_date
from candlewick.operators.signals import high_risk
from candlewick.operators.tables import as_instant

_BAR_COLUMNS = ("window_start", "open", "high", "low", "close", "sma_5min", "vwap", "total_volume")


Moment = datetime | str | Column | None


def _on_day(table: DataFrame, symbol: str, as_of: Moment) -> DataFrame:
    return table.filter((F.col("symbol") == symbol) & (F.col("date_bucket") == utc_date(as_instant(as_of))))


def recent_bars(bars: DataFrame, symbol: str, as_of: Moment = None, limit: int | None = None) -> DataFrame:
    """Bars of the current UTC day, newest first; with `limit`, only the newest so many."""
    rows = _on_day(bars, symbol, as_of).select(*_BAR_COLUMNS).orderBy(F.desc("window_start"))
    return rows if limit is None else rows.limit(limit)


def last_day_bars(bars: DataFrame, symbol: str, as_of: Moment = None) -> DataFrame:
    """Bars that started in the 24 hours up to `as_of`, newest first; reads two day buckets at most."""
    now = as_instant(as_of)
    since = now - F.expr("interval 24 hours")
    chosen = bars.filter(
        (F.col("symbol") == symbol)
        & F.col("date_bucket").between(utc_date(since), utc_date(now))
        & (F.col("window_start") > since)
        & (F.col("window_start") <= now)
    )
    return chosen.select(*_BAR_COLUMNS).orderBy(F.desc("window_start"))


def todays_alerts(signals: DataFrame, symbol: str, as_of: Moment = None) -> DataFrame:
    """High-risk signals of the current UTC day, newest first."""
    return (
        high_risk(_on_day(signals, symbol, as_of))
        .select("window_start", "risk_level", "alert_message", "price_deviation_pct", "buy_pressure")
        .orderBy(F.desc("window_start"))
    )


def recent_health(
    health: DataFrame, as_of: Moment = None, component: str = "producer", hours: int = 1
) -> DataFrame:
    """Metrics of a component younger than `hours`, newest first; one exactly that old is out."""
    since = as_instant(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return (
        health.filter((F.col("component") == component) & (F.col("metric_time") > since))
        .select("component", "metric_time", "messages_per_sec", "avg_latency_ms")
        .orderBy(F.desc("metric_time"))
    )
