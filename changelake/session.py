"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution measures shuffle sizes, merges small partitions, splits skewed ones and turns a join
# into a broadcast join when a side turns out small. Forcing the split keeps it when the join's partitioning
# is used again, at the cost of one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # top-k windows keep k rows in every task before the shuffle, also for a large k
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that runs already."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A session on this machine for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("changelake")
    defaults = {
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # spares a stack capture for every column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**SETTINGS, **defaults, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
