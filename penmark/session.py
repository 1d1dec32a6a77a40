"""Session defaults and the shared folder for tables that outlive one job."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning instead of fixed partition counts: AQE merges small
# shuffle partitions and splits skewed join partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide shuffles, of which AQE merges what is too small for a task of its own.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "penmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` entries win over them.

    The master and the shuffle width come from spark-submit unless given here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Local sessions without the setting get a folder of their own; a cluster
    without it is an error, because a driver-local folder would not be visible
    to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="penmark-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")
