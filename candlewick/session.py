"""Session settings the operators rely on, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Results depend on the UTC zone; the rest only affects speed.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# State lives off-heap and only its changes are uploaded per batch, so the number of open
# (symbol, window) groups is not bound by executor heap.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_CONF, **STREAM_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone on a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same application for a stateful job.

    The first checkpoint fixes how many partitions a job's state has, so it is chosen per job: by default
    one per core of the cluster.
    """
    session = spark.newSession()
    for name, value in {**SESSION_CONF, **STREAM_CONF}.items():
        session.conf.set(name, value)
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's `spark.checkpoint.dir`.

    A local folder serves only where that is unset and all tasks run in this process; any other master needs
    the setting, as its executors could not see the folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share (master is {master})")
    return tempfile.mkdtemp(prefix=f"{purpose}-")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows to a shared scratch folder and read them back: later steps do not compute them again."""
    spark = rows.sparkSession
    folder = scratch_folder(spark, purpose)
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
