"""Session construction and the shared folder for materialised data."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app: str = "riskhouse",
    driver_memory: str = "8g",
) -> SparkSession:
    """Local/test session.  On a cluster, use the cluster's session instead."""
    master = master or os.environ.get("RISKHOUSE_MASTER", "local[*]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors for tables and checkpoints.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir) from the
    session.  Only when neither is set on a local master -- tests -- a fresh
    folder is made and registered, so ``DataFrame.checkpoint()`` works too;
    on a cluster a machine-local folder would be wrong, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; rely on the session conf
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        jd = sc._jsc.sc().getCheckpointDir()
        d = jd.get() if jd.isDefined() else None
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="riskhouse-")
    if sc is not None and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused location under the shared folder."""
    return f"{shared_dir(spark)}/riskhouse/{name}-{uuid.uuid4().hex}"


def file_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files: equal states are the same content."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def recommended_conf(input_bytes: int, partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Settings that size scans and shuffles to the input, for cluster runs.

    One initial shuffle partition per ``partition_bytes`` of input (AQE then
    coalesces small ones and splits skewed ones), scan splits of the same
    size, and skew detection relative to that size.
    """
    parts = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 4),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared folder), cutting lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
