"""Momentum over the bars of each symbol."""

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from candlewick import settings
from candlewick.functions import utc_date
from candlewick.session import stored

# Bars handled by one task at a time; a symbol with more is split.
_BLOCK_BARS = 100_000
_RANGE_SECONDS = 30 * 86400


def _numbered(bars: DataFrame) -> DataFrame:
    """Add `bar_no`, the position of each bar in its symbol, without sorting a whole symbol in one task.

    Bars are numbered inside fixed time ranges; the counts of the earlier ranges, one row per symbol
    and range, give each range its first number.
    """
    ranged = bars.withColumn("part", F.floor(F.unix_seconds("window_start") / F.lit(_RANGE_SECONDS)))
    earlier = Window.partitionBy("symbol").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("symbol", "part").agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select("symbol", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("symbol", "part").orderBy("window_start")
    ranked = ranged.withColumn("rank", F.row_number().over(inside))
    numbered = ranked.join(starts, ["symbol", "part"]).withColumn("bar_no", F.col("start") + F.col("rank") - 1)
    return numbered.drop("part", "rank", "start")


def rsi(bars: DataFrame, period: int = settings.RSI_PERIOD, block_bars: int = _BLOCK_BARS) -> DataFrame:
    """Relative strength index over the last `period` price changes, plain means of gains and losses.

    NULL until a symbol has `period` changes; 100 without a loss. A symbol is worked on in blocks of
    `block_bars` bars, each also given the `period` bars before it, so no task holds a whole symbol. The bars
    are read once: their closes are stored, as numbering and index both need them.
    """
    if block_bars < period:
        raise ValueError("a block must hold at least one period")
    closes = stored(bars.select("symbol", "window_start", "close"), "closes")
    number, width = F.col("bar_no"), F.lit(block_bars)
    block = F.floor(number / width)
    feeds_next = number % width >= width - period
    spread = (
        _numbered(closes)
        .withColumn("home", block)
        .withColumn(
            "block",
            F.explode(F.when(feeds_next, F.array(block, block + 1)).otherwise(F.array(block))),
        )
    )
    means = _means(spread, Window.partitionBy("symbol", "block").orderBy("bar_no"), period)
    return means.filter(F.col("home") == F.col("block")).select(
        "symbol", "window_start", "close", _index(period).alias(f"rsi_{period}")
    )


def _means(rows: DataFrame, ordered: WindowSpec, period: int) -> DataFrame:
    """Add how many changes the last `period` bars have, and their mean gain and loss."""
    recent = ordered.rowsBetween(1 - period, 0)
    changes = rows.withColumn("change", F.col("close") - F.lag("close").over(ordered))
    gain = F.when(F.col("change") > 0, F.col("change")).otherwise(0.0)
    loss = F.when(F.col("change") < 0, -F.col("change")).otherwise(0.0)
    return changes.select(
        "*", F.count("change").over(recent).alias("changes"),
        F.avg(gain).over(recent).alias("gain"), F.avg(loss).over(recent).alias("loss"),
    )


def _index(period: int) -> Column:
    index = F.when(F.col("loss") == 0, F.lit(100.0)).otherwise(
        100.0 - 100.0 / (1.0 + F.try_divide(F.col("gain"), F.col("loss")))
    )
    return F.when(F.col("changes") == period, F.round(index, 4))


def rsi_after(bars: DataFrame, carried: DataFrame, period: int = settings.RSI_PERIOD) -> DataFrame:
    """The index of a batch of bars, given the last `period` closes of each symbol before them (`last_closes`).

    Bars must be later than those carried; any number of batches, one after the other, give what `rsi` gives at once.
    """
    columns = ("symbol", "window_start", "close")
    rows = carried.select(*columns, F.lit(True).alias("old")).unionByName(bars.select(*columns, F.lit(False).alias("old")))
    means = _means(rows, Window.partitionBy("symbol").orderBy("window_start"), period)
    return means.filter(~F.col("old")).select(
        "symbol", utc_date(F.col("window_start")).alias("date_bucket"), "window_start", "close",
        _index(period).alias(f"rsi_{period}"),
    )


def last_closes(bars: DataFrame, carried: DataFrame, period: int = settings.RSI_PERIOD) -> DataFrame:
    """The last `period` closes of each symbol: all that later bars need to know. Each task sends on so many at most."""
    columns = ("symbol", "window_start", "close")
    rows = carried.select(*columns).unionByName(bars.select(*columns))
    newest = Window.partitionBy("symbol").orderBy(F.desc("window_start"))
    return rows.withColumn("place", F.row_number().over(newest)).filter(F.col("place") <= period).drop("place")
