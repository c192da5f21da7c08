"""Views over keyed tables."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.functions import utc_date


def as_instant(moment: datetime | str | Column | None = None) -> Column:
    """`moment` as a timestamp; the current time when left out."""
    if moment is None:
        return F.current_timestamp()
    return moment if isinstance(moment, Column) else F.lit(str(moment)).cast("timestamp")


def newest_versions(versions: DataFrame, key: Sequence[str], version: str = "written_at") -> DataFrame:
    """The row of the highest version per key: last write wins.

    Spark limits each task to one row per key before the shuffle, and filters on key columns pass
    through to the scan.
    """
    newest_first = Window.partitionBy(*key).orderBy(F.desc(version))
    return versions.withColumn("place", F.row_number().over(newest_first)).filter("place = 1").drop("place")


def latest_signals(signals: DataFrame) -> DataFrame:
    """The newest signal of each symbol; each task sends one row per symbol to the shuffle."""
    return _newest(signals.select(*_latest_columns(signals)), F.col("window_start"))


def _latest_columns(signals: DataFrame) -> list[str]:
    return [
        "symbol", "date_bucket", "window_start", "risk_level", "alert_message", "close",
        *[name for name in signals.columns if name.startswith("sma_")],
        "buy_pressure", "price_deviation_pct", "volume_spike",
    ]


def _newest(rows: DataFrame, order: Column) -> DataFrame:
    kept = [name for name in rows.columns if name != "symbol"]
    newest = rows.groupBy("symbol").agg(F.max_by(F.struct(*kept), order).alias("newest"))
    return newest.select("symbol", "newest.*")


def merged_latest(view: DataFrame, signals: DataFrame) -> DataFrame:
    """A view of the newest signal per symbol after some more signals; of one window, the signal that came later counts."""
    held = view.withColumn("given", F.lit(0))
    found = signals.select(*_latest_columns(signals), F.lit(1).alias("given"))
    return _newest(held.unionByName(found), F.struct("window_start", "given")).drop("given")


def retain(table: DataFrame, time_column: str, days: int, as_of: datetime | str | Column | None = None) -> DataFrame:
    """Rows not older than `days` at `as_of`; a table split by `date_bucket` also skips its old folders."""
    oldest = as_instant(as_of) - F.make_dt_interval(F.lit(days))
    kept = table.filter(F.col(time_column) >= oldest)
    if "date_bucket" in table.columns:
        kept = kept.filter(F.col("date_bucket") >= utc_date(oldest))
    return kept
