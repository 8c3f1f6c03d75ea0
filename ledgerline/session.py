"""Session helpers.

The library never creates a session behind the caller's back; these helpers are for tests,
the bench and small scripts. On a cluster, pass your own session and keep its settings.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC clock arithmetic, adaptive execution (coalescing,
# skew-join splitting, runtime broadcast), and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # windows-1251 export (S6) needs the legacy charset switch in Spark 4.
    "spark.sql.legacy.javaCharsets": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; wide projections (the
    # record fixtures, several formatters side by side) then run faster per expression than as
    # one fused method. The Spark docs recommend this value on HotSpot.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "ledgerline") -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    n = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
    builder = (builder.config("spark.sql.shuffle.partitions", str(n))
               .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "16g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder: the one named in ``spark.checkpoint.dir`` or set on
    the context, else a folder inside the session's warehouse, which driver and executors share."""
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    spark.sparkContext.setCheckpointDir(
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/ledgerline-checkpoints")
    return spark.sparkContext.getCheckpointDir()
