"""A stored table fed to a live job as it would have arrived: delivery by delivery, one micro-batch each, with restarts."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.session import stream_session

# A delivery is written as so many rows a file; every delivery has the same number of files.
_ROWS_A_FILE = 1_000_000


def replay(
    rows: DataFrame,
    folder: str,
    start: Callable[[DataFrame], StreamingQuery],
    sessions: Sequence[Sequence[int]],
    delivery: str = "delivery",
) -> list[dict]:
    """Run a job over the deliveries of `rows` and return the progress of its micro-batches.

    The number in column `delivery` says with which one a row arrives. Each session brings its deliveries, starts the job on
    the stream of all that came so far and lets it run to the end: every delivery is a micro-batch, and between two sessions
    the job is stopped and goes on from its checkpoint. `start` must use a trigger that ends at the end of the input.
    """
    spark = rows.sparkSession
    rows.write.partitionBy(delivery).parquet(f"{folder}/staged")
    schema = rows.drop(delivery).schema
    sizes = spark.read.parquet(f"{folder}/staged").groupBy(delivery).agg(F.count(F.lit(1)).alias("size")).collect()
    files = max(1, min((row["size"] for row in sizes), default=0) // _ROWS_A_FILE)
    live, progress, given = stream_session(spark), [], {row[delivery] for row in sizes}
    for session in sessions:
        for number in session:
            if number in given:
                part = spark.read.schema(schema).parquet(f"{folder}/staged/{delivery}={number}")
                part.repartition(files).write.mode("append").parquet(f"{folder}/feed")
        # The source takes files in the order they were finished, so many to a batch.
        stream = live.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/feed")
        query = start(stream)
        query.awaitTermination()
        progress += query.recentProgress
    return progress
