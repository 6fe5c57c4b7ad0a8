"""Session settings the operators rely on, and durable cut points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    # Epoch conversions and zone-less timestamps are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # transformWithState needs the RocksDB state store.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS applied; `settings` use `__` for the dots in a key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to the cluster's checkpoint folder and read it back from there.

    The folder is the one the session names in spark.checkpoint.dir. Without it, as in tests, a
    folder in the session's warehouse takes its place, which is shared too.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
