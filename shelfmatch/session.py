"""Session settings for local runs; on a cluster the session comes from the cluster."""

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores=None, app="shelfmatch"):
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SHELFMATCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shelfmatch-"))
        .config("spark.sql.files.openCostInBytes", "1m")  # small tables, yet a split per core
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
