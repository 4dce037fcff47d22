"""Spark session helpers.

The job never hard-codes a master or a scratch folder.  On a cluster the
session comes from the launcher; tests and the bench build a local one.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every tandem job relies on.  AQE re-plans joins at runtime
# (broadcast when a shuffled side turns out small, skew splitting) and
# coalesces small shuffle partitions.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Local wall times are TIMESTAMP_NTZ and every zone shift names its zone,
    # so results never depend on this; pinned for readable output only.
    "spark.sql.session.timeZone": "UTC",
}


def split_wide_code(spark: SparkSession) -> None:
    """Lets Spark run a stage operator by operator, in code it splits into small methods,
    where the stage as one piece would need a method of over 8,000 bytes: Java never
    compiles such a method, so each row of a wide projection or rollup would be
    interpreted.  Set where the session leaves Spark's default; results do not depend on it."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit) == "65535":
        spark.conf.set(limit, "8000")


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "tandem") -> SparkSession:
    """A local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    parts = shuffle_partitions or (8 if cores == "*" else max(int(cores), 1))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "1000")  # plans show long paths whole
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", os.environ.get("TANDEM_DRIVER_MEMORY", "8g"))
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset (tests, local bench) do we set
    a scratch folder of our own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local SparkContext
        sc = None
    current = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not current:
        if sc is None or not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tandem-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current
