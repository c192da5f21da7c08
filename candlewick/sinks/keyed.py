"""Tables with a primary key on plain Parquet: the newest write of a key wins.

Each batch of a writer adds one folder of row versions, stamped with the time of writing; readers take the
newest version per key. A batch that is run again replaces its own folder. A folder counts once Spark has
put its success marker there, so a half-written one is never read. `compact` folds the versions into one
folder of current rows.

    <path>/delta/writer=<w>/batch_id=<n>/   versions of one batch
    <path>/base/version=<k>/                current rows at a compaction
    <path>/folded/version=<k>/              the batch folders that base replaces, with the time each was finished

A batch folder that is written again after it was folded has another time: it counts as new.

Below a batch folder, rows lie in folders of one day (or another bucket). Reads of some days open only theirs, and files
whose Bloom filter rules out the symbol are left unread; `expire` drops whole days by the folder's name.
"""

import logging
import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from candlewick import schemas, settings
from candlewick.functions import utc_date
from candlewick.operators.tables import as_instant, newest_versions, retain
from candlewick.sinks.layout import gather

logger = logging.getLogger(__name__)

_STAMP = "written_at"
_LEAST_TASKS = 4
# Sizes the Bloom filters, about 10 bits for each.
_SYMBOLS_A_FILE = 10_000


class KeyedTable:
    def __init__(
        self,
        path: str,
        schema: T.StructType,
        key: Sequence[str],
        time_column: str,
        bucket: str | None = None,
        lookup: str | None = None,
    ):
        """`bucket` is the column the folders of a batch are split by: one of the key, or else the UTC day of `time_column`,
        kept under that name beside the rows. Files get a Bloom filter on `lookup`.
        """
        self.path = path.rstrip("/")
        self.schema = schema
        self.key = list(key)
        self.time_column = time_column
        self.bucket = bucket
        self.lookup = lookup
        self._derived = bool(bucket) and bucket not in schema.names
        own_day = [T.StructField(bucket, T.DateType())] if self._derived else []
        self._stored = T.StructType([*schema.fields, *own_day, T.StructField(_STAMP, T.TimestampType())])

    # -- writing ---------------------------------------------------------------------------------

    def upsert(self, batch: DataFrame, batch_id: int, writer: str = "main") -> dict[str, int]:
        """Write one batch of rows, unique by key; returns its row counts.

        `writer` and `batch_id` name the batch: the same pair again replaces it. The batch is computed and read
        once: the rows are counted on their way into the files. A batch without rows leaves nothing behind.
        """
        folder = f"{self.path}/delta/writer={writer}/batch_id={batch_id}"
        result = self._write(batch.withColumn(_STAMP, F.current_timestamp()), folder)
        if result["rows"]:
            logger.info("%s writer %s batch %s: %s", self.path, writer, batch_id, result)
        else:
            delete_folder(batch.sparkSession, folder)
        return result

    def _write(self, rows: DataFrame, folder: str) -> dict[str, int]:
        """Rows with a full key, newest first within a file; the bucket leads, as the folders need it."""
        if self._derived:
            rows = rows.withColumn(self.bucket, utc_date(F.col(self.time_column)))
        stored = rows.select(*self._stored.names).dropna(subset=self.key)
        order = [name for name in self.key if name not in (self.bucket, self.time_column)]
        buckets = [self.bucket] if self.bucket else []
        order = buckets + order
        # A micro-batch often falls into one bucket: a share of the shuffle partitions writes it.
        spread = max(_LEAST_TASKS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
        # Counted behind the shuffle: an empty one is cut out of the plan with all that stands before it.
        counted, counts = Observation(), [F.count(F.lit(1)).alias("rows")]
        if "risk_level" in self.schema.names:
            counts.append(F.count_if(F.col("risk_level").isin(*settings.HIGH_RISK)).alias("high_risk"))
        stored = gather(stored, buckets, self.key, spread).observe(counted, *counts)
        writer = stored.sortWithinPartitions(*order, F.desc(self.time_column)).write.mode("overwrite")
        if self.lookup:
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.lookup}", "true").option(
                f"parquet.bloom.filter.expected.ndv#{self.lookup}", str(_SYMBOLS_A_FILE)
            )
        writer.partitionBy(*buckets).parquet(folder)
        return counted.get

    # -- reading ---------------------------------------------------------------------------------

    def versions(self, spark: SparkSession) -> DataFrame:
        """All row versions since the newest compaction, with the time each was written."""
        base = self._newest_base(spark)
        return self._read(spark, base, self._open_batches(spark, base))

    def _read(self, spark: SparkSession, base: int | None, batches: list[str]) -> DataFrame:
        folders = batches if base is None else [*batches, self._base(base)]
        if not folders:
            return spark.createDataFrame([], self._stored)
        if not self.bucket:
            return spark.read.schema(self._stored).parquet(*folders)
        # The folders lie at two depths; each depth is one scan with the bucket as its partition column.
        scans = [
            spark.read.schema(self._stored).option("basePath", root).parquet(*chosen).select(*self._stored.names)
            for root in (f"{self.path}/delta", f"{self.path}/base")
            if (chosen := [folder for folder in folders if folder.startswith(f"{root}/")])
        ]
        return scans[0] if len(scans) == 1 else scans[0].unionByName(scans[1])

    def current(
        self, spark: SparkSession, since: datetime | str | None = None, until: datetime | str | None = None
    ) -> DataFrame:
        """The newest version of every key; with `since` or `until` only rows of these times, both included.

        Where folders are days, others are not opened. All versions of a key have its time, so they are chosen
        before the newest is looked for; later filters on key columns reach the scan as well.
        """
        versions = self.versions(spark)
        at, day = F.col(self.time_column), self.bucket if self._by_day() else None
        if since is not None:
            versions = versions.filter(at >= as_instant(since))
            versions = versions.filter(F.col(day) >= utc_date(as_instant(since))) if day else versions
        if until is not None:
            versions = versions.filter(at <= as_instant(until))
            versions = versions.filter(F.col(day) <= utc_date(as_instant(until))) if day else versions
        return newest_versions(versions, self.key, _STAMP).select(*self.schema.names)

    def _by_day(self) -> bool:
        return bool(self.bucket) and isinstance(self._stored[self.bucket].dataType, T.DateType)

    # -- upkeep ----------------------------------------------------------------------------------

    def compact(
        self, spark: SparkSession, keep_days: int | None = None, as_of: datetime | str | None = None
    ) -> int | None:
        """Write the current rows as the next base version and return its number.

        Writers may go on: batches they add meanwhile stay open. Should a batch be run again just now, its
        missing files fail the compaction, which then changes nothing. With `keep_days`, older rows (by
        event time, seen from `as_of`) are left out. Without batches to fold, nothing is written.
        """
        base = self._newest_base(spark)
        batches = self._batches(spark)
        open_batches = self._open_batches(spark, base, batches)
        if not open_batches:
            return base
        number = 0 if base is None else base + 1
        rows = newest_versions(self._read(spark, base, open_batches), self.key, _STAMP)
        if keep_days is not None:
            rows = retain(rows, self.time_column, keep_days, as_of)
        listed = [(f"{stamp} {self._relative(folder)}",) for folder, stamp in batches.items()]
        names = spark.createDataFrame(listed, "value string")
        names.coalesce(1).write.mode("overwrite").text(f"{self.path}/folded/version={number}")
        self._write(rows, self._base(number))
        return number

    def drop_superseded(self, spark: SparkSession) -> int:
        """Delete the folders the newest base replaces; call it when no reader still uses them."""
        newest = self._newest_base(spark)
        if newest is None:
            return 0
        gone = self._folded(spark, newest)
        old = [folder for folder, stamp in self._batches(spark).items() if gone.get(self._relative(folder)) == stamp]
        old += [self._base(number) for number in self._bases(spark) if number < newest]
        for folder in old:
            delete_folder(spark, folder)
        return len(old)

    def expire(self, spark: SparkSession, days: int, as_of: datetime | str | None = None) -> dict[str, int]:
        """Drop rows older than `days` at `as_of`; returns how many folders went and how many rows were written anew.

        Folders of older days go by their name, unread. Only the day that is partly too old is read: what stays of
        it is written as one more batch, with its versions and their stamps, before its folders go. A run that is cut
        off leaves rows double, which readers do not see, and the next run ends its work. Batches that are being written
        meanwhile are left alone.
        """
        if not self._by_day():
            raise ValueError("only a table in folders of days can drop them")
        oldest = as_instant(as_of) - F.make_dt_interval(F.lit(days))
        border, number = spark.range(1).select(
            utc_date(oldest).cast("string"), F.unix_millis(F.current_timestamp())
        ).first()
        gone, split = [], []
        finished = [*self._batches(spark), *[self._base(version) for version in self._bases(spark)]]
        for folder in _folders(spark, [f"{batch}/{self.bucket}=*" for batch in finished]):
            day = folder.rsplit("=", 1)[1]
            if re.fullmatch(r"\d{4}-\d{2}-\d{2}", day) and day <= border:
                (split if day == border else gone).append(folder)
        kept = {"rows": 0}
        if split:
            plain = T.StructType([item for item in self._stored.fields if item.name != self.bucket])
            rows = spark.read.schema(plain).parquet(*split).withColumn(self.bucket, F.lit(border).cast("date"))
            folder = f"{self.path}/delta/writer=expire/batch_id={number}"
            kept = self._write(rows.filter(F.col(self.time_column) >= oldest), folder)
        for folder in [*gone, *split]:
            delete_folder(spark, folder)
        return {"folders": len(gone) + len(split), "rows": kept["rows"]}

    # -- folders ---------------------------------------------------------------------------------

    def _base(self, number: int) -> str:
        return f"{self.path}/base/version={number}"

    def _relative(self, folder: str) -> str:
        return "/".join(folder.split("/")[-2:])

    def _batches(self, spark: SparkSession) -> dict[str, int]:
        """Finished batch folders, and when each was finished."""
        found = finished_folders(spark, f"{self.path}/delta/writer=*/batch_id=*")
        return {f"{self.path}/delta/{self._relative(folder)}": stamp for folder, stamp in found.items()}

    def _bases(self, spark: SparkSession) -> list[int]:
        found = finished_folders(spark, f"{self.path}/base/version=*")
        return [int(re.search(r"version=(\d+)$", folder).group(1)) for folder in found]

    def _newest_base(self, spark: SparkSession) -> int | None:
        return max(self._bases(spark), default=None)

    def _folded(self, spark: SparkSession, number: int) -> dict[str, int]:
        """Batch folders in a base: one short name and time for each that was there when it was written."""
        rows = spark.read.text(f"{self.path}/folded/version={number}").collect()
        return {name: int(stamp) for stamp, name in (row.value.split(" ", 1) for row in rows)}

    def _open_batches(self, spark: SparkSession, base: int | None, batches: dict[str, int] | None = None) -> list[str]:
        folded = {} if base is None else self._folded(spark, base)
        found = self._batches(spark) if batches is None else batches
        return [folder for folder, stamp in found.items() if folded.get(self._relative(folder)) != stamp]


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def finished_folders(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Folders Spark has finished writing, and when, in milliseconds."""
    place, files = _hadoop(spark, f"{pattern}/_SUCCESS")
    return {
        status.getPath().getParent().toString(): status.getModificationTime() for status in files.globStatus(place) or []
    }


def _folders(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """The folders that match, below the folders as they were given."""
    found = []
    for pattern in patterns:
        place, files = _hadoop(spark, pattern)
        parent = pattern.rsplit("/", 1)[0]
        found += [f"{parent}/{status.getPath().getName()}" for status in files.globStatus(place) or [] if status.isDirectory()]
    return found


def delete_folder(spark: SparkSession, folder: str) -> None:
    place, files = _hadoop(spark, folder)
    files.delete(place, True)


def bar_table(path: str) -> KeyedTable:
    return KeyedTable(path, schemas.BAR, ("symbol", "date_bucket", "window_start"), "window_start", "date_bucket", "symbol")


def signal_table(path: str) -> KeyedTable:
    return KeyedTable(path, schemas.SIGNAL, ("symbol", "date_bucket", "window_start"), "window_start", "date_bucket", "symbol")


def alert_table(path: str) -> KeyedTable:
    return KeyedTable(path, schemas.ALERT, ("symbol", "risk_level", "alert_time"), "alert_time", "alert_day", "symbol")


def health_table(path: str) -> KeyedTable:
    return KeyedTable(path, schemas.HEALTH, ("component", "metric_time"), "metric_time", "metric_day", "component")


def pane_table(path: str) -> KeyedTable:
    return KeyedTable(path, schemas.PANE, ("symbol", "date_bucket", "window_start"), "window_start", "date_bucket", "symbol")


def rsi_table(path: str) -> KeyedTable:
    return KeyedTable(path, schemas.RSI, ("symbol", "date_bucket", "window_start"), "window_start", "date_bucket", "symbol")
