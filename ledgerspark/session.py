"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on: UTC and AQE with skew-join splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "ledgerspark",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster the master and most sizing come from spark-submit; pass
    ``master`` only for local runs and tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    Progress and checkpoints must outlive the driver's machine, so an unset
    folder is an error; tests set their own.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current and not sc.getCheckpointDir():
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current or sc.getCheckpointDir()
