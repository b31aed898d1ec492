"""SparkSession for tests, benchmarks and local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session with AQE on and the UI off; ``checkpoint_dir`` is its work folder."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("provgraph")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Rows dealt by physician serve joins on (physician, company) as they are.
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # Local runs keep every job's plan and metrics in the driver; cap
        # that history so long sessions (tests, bench loops) do not slow down.
        .config("spark.sql.ui.retainedExecutions", "20")
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "200")
        .config("spark.ui.retainedTasks", "2000")
    )
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    if checkpoint_dir:
        # spark.checkpoint.dir is static: it can only be given to the builder.
        b = b.config("spark.checkpoint.dir", checkpoint_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
