"""Session construction for tests, the bench and local use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "palaver", driver_memory: str = "8g",
                  **extra: str) -> SparkSession:
    """A session with the settings the operators rely on.

    On a cluster only the engine settings matter: AQE on (it coalesces the
    shuffle partitions, splits skewed join partitions and turns small measured
    join sides into broadcasts) and a UTC session time zone.  The shuffle
    partition count there is the cluster's own choice.
    """
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        # Call sites of every column expression are only for error messages.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
