"""Session settings the jobs rely on."""

from pyspark.sql import SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Turn on adaptive execution with skew-join splitting, and pin the time zone.

    Joins of fact rows to one row per key keep their hot keys on the fact side; adaptive
    execution splits those partitions. It gives up when that costs another shuffle unless it
    is told to go ahead, and a shuffle is always cheaper here than one task with a third of
    the rows.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark


def shuffle_width(spark: SparkSession) -> int:
    """How many shares a hot group is cut into: one per shuffle partition."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staging_folder(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for intermediate tables, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None)
