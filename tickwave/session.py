"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tickwave", driver_memory: str = "8g") -> SparkSession:
    """Session used by tests and bench.  Cluster jobs get their session from the
    platform; nothing in the library depends on these settings except the
    session time zone, which every entry point checks."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # size coalesced shuffle partitions by bytes (advisory 64 MB), not by
        # keeping the default parallelism: tiny stages run as few tasks and
        # large ones still split by size
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # no per-call Python call-site capture while building plans (it only
        # enriches error messages and costs a session lookup per function)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform to a shared file system and is
    only read here.  Where it is unset (local tests) a private folder is
    created and registered, so ``checkpoint()`` and written scratch tables
    work the same way in both places.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="tickwave-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet to a fresh folder of the shared checkpoint
    directory and read it back.

    Used where one intermediate feeds several branches.  Unlike
    ``DataFrame.checkpoint()`` (which runs the plan a second time to write its
    files unless the data is also cached), this computes the plan once, stores
    it columnar and compressed, and cuts lineage: a lost executor re-reads the
    files instead of recomputing upstream stages."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
