"""Small tables kept up to date batch by batch: each batch merges into what was there before.

    <path>/writer=<w>/batch_id=<n>/     the whole view after batch n of a writer

A batch reads the view its predecessor left and writes the next one, so a batch that is run again starts from the same
view and replaces its own result. Readers take the newest finished view.
"""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from candlewick.sinks.keyed import delete_folder, finished_folders

# Older views that stay for readers who still use them, and for a batch that is run again.
_KEPT = 3


class MergedView:
    def __init__(self, path: str, schema: T.StructType):
        self.path = path.rstrip("/")
        self.schema = schema

    def before(self, spark: SparkSession, batch_id: int, writer: str) -> DataFrame:
        """The view a batch goes on from. A writer without a view of its own takes the newest of any other."""
        versions = self._versions(spark)
        own = [version for version in versions if version[0] == writer and version[1] < batch_id]
        others = [version for version in versions if version[0] != writer]
        return self._read(spark, max(own, default=None) or max(others, key=versions.get, default=None))

    def merge(self, spark: SparkSession, batch_id: int, writer: str, combine: Callable[[DataFrame], DataFrame]) -> None:
        """Make `combine(view before this batch)` the view."""
        rows = combine(self.before(spark, batch_id, writer)).select(*self.schema.names)
        rows.write.mode("overwrite").parquet(self._folder(writer, batch_id))
        own = sorted(number for name, number in self._versions(spark) if name == writer and number < batch_id)
        for number in own[:-_KEPT]:
            delete_folder(spark, self._folder(writer, number))

    def current(self, spark: SparkSession) -> DataFrame:
        versions = self._versions(spark)
        return self._read(spark, max(versions, key=versions.get, default=None))

    def _folder(self, writer: str, batch_id: int) -> str:
        return f"{self.path}/writer={writer}/batch_id={batch_id}"

    def _read(self, spark: SparkSession, version: tuple[str, int] | None) -> DataFrame:
        if version is None:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._folder(*version))

    def _versions(self, spark: SparkSession) -> dict[tuple[str, int], tuple[int, int]]:
        """(writer, batch) of each finished view, and an order of their age."""
        found = {}
        for folder, stamp in finished_folders(spark, f"{self.path}/writer=*/batch_id=*").items():
            writer, number = re.search(r"writer=([^/]+)/batch_id=(\d+)$", folder).groups()
            found[writer, int(number)] = (stamp, int(number))
        return found
