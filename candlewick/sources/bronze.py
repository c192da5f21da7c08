"""Stored trades, by ingest folder or by the time of the trades.

A zone map beside the trades holds the first and last trade time of every file. It grows by what it does not know yet: each new
file is opened once, for one column. Reads by trade time then choose files before any footer is opened.
"""

from collections.abc import Sequence

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick import schemas
from candlewick.functions import day_ranges

# Spark's listings pass over names that begin so.
_ZONES = "_zones"


def read_bronze(
    spark: SparkSession,
    path: str,
    days: Sequence[str] | None = None,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Stored trades of some ingest days ('yyyy/MM/dd') and symbols; both prune folders, not rows."""
    trades = spark.read.schema(schemas.TRADE).parquet(path)
    if days is not None:
        trades = trades.filter(F.col("date_partition").isin(*days))
    if symbols is not None:
        trades = trades.filter(F.col("symbol").isin(*symbols))
    return trades.select(*schemas.TRADE.names)


def _files(spark: SparkSession, path: str) -> list[str]:
    """Every stored file from its day folder on, by listing alone."""
    found = spark.read.schema(schemas.TRADE).parquet(path).inputFiles()
    return [unquote(file[file.rindex("/date_partition=") + 1 :]) for file in found]


def _read(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    reader = spark.read.schema(schemas.TRADE).option("basePath", path)
    return reader.parquet(*[f"{path.rstrip('/')}/{file}" for file in files])


def refresh_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone map `file, first_ms, last_ms, trades` of all stored files, after adding those it did not have.

    A file is named from its day folder on. Two runs at once may add a file twice, which changes nothing; files that are
    gone are left out.
    """
    folder = f"{path.rstrip('/')}/{_ZONES}"
    listed = spark.createDataFrame([(file,) for file in _files(spark, path)], "file string")
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    known = spark.read.schema(schemas.ZONE).parquet(folder) if there else spark.createDataFrame([], schemas.ZONE)
    fresh = [row["file"] for row in listed.join(known, "file", "left_anti").collect()]
    if fresh:
        place_of = F.regexp_extract("_metadata.file_path", "/(date_partition=[^/]*/[^/]*/[^/]*)$", 1)
        trades = _read(spark, path, fresh)
        zones = trades.groupBy(F.url_decode(F.replace(place_of, F.lit("+"), F.lit("%2B"))).alias("file")).agg(
            F.min("trade_time_ms").alias("first_ms"), F.max("trade_time_ms").alias("last_ms"),
            F.count(F.lit(1)).alias("trades"),
        )
        zones.select(*schemas.ZONE.names).coalesce(1).write.mode("append").parquet(folder)
        known = spark.read.schema(schemas.ZONE).parquet(folder)
    return known.dropDuplicates(["file"]).join(listed, "file", "left_semi")


def read_days(
    spark: SparkSession, path: str, days: Sequence[str], symbols: Sequence[str] | None = None
) -> DataFrame:
    """The stored trades of some UTC days ('yyyy/MM/dd') by trade time, in whatever ingest folder they are.

    Only files whose zone meets one of the days are read; their names, as many as the days need, pass the driver.
    """
    zones, wanted, at = refresh_zones(spark, path), F.lit(False), F.col("trade_time_ms")
    ours = F.lit(False)
    for start, end in day_ranges(days):
        wanted = wanted | ((F.col("last_ms") >= start) & (F.col("first_ms") < end))
        ours = ours | ((at >= start) & (at < end))
    chosen = [row["file"] for row in zones.filter(wanted).select("file").collect()]
    if not chosen:
        return spark.createDataFrame([], schemas.TRADE)
    trades = _read(spark, path, chosen).filter(ours)
    if symbols is not None:
        trades = trades.filter(F.col("symbol").isin(*symbols))
    return trades.select(*schemas.TRADE.names)
