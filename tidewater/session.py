"""Spark session settings used by the tests, the bench and the entry points.

On a cluster the session is given; ``configure`` only fills in what the
builders rely on (UTC session zone, AQE) and leaves every other setting,
``spark.checkpoint.dir`` included, as the cluster set it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewater") -> SparkSession:
    """A local session for tests and the bench (UI off, no server started)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
