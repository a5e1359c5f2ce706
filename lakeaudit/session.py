"""Session settings the jobs are designed for.

On a cluster the deployment supplies master, memory, ``spark.checkpoint.dir`` and the number of
shuffle partitions; ``recommended_conf`` only carries what the plans rely on.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def recommended_conf() -> dict[str, str]:
    return {
        # Timestamps are parsed and compared as UTC everywhere.
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even when it costs one more exchange above the join.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Checkpointed intermediates are dropped once no plan refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lakeaudit")
    for key, value in recommended_conf().items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
