"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  Timestamps are
# TIMESTAMP_NTZ throughout; UTC only pins the rendering of any LTZ value.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimensions are joined by broadcast only while Spark's size estimate
    # (and, under AQE, the measured shuffle size) stays under this bound;
    # beyond it the same join runs as a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "order_mart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(key, conf[key])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or an earlier
    ``setCheckpointDir``).  Only a local-mode session without one gets a
    fresh scratch folder, so tests run anywhere; a cluster session without a
    configured shared folder is an error rather than a silent fallback to a
    machine-local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="order_mart-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged files."""
    import uuid
    base = checkpoint_dir(spark)
    return os.path.join(base, "order_mart", f"{name}-{uuid.uuid4().hex}")


def sizing(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.25,
           target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition settings sized to the data rather than fixed numbers.

    * scan splits of ``target_partition_bytes`` (one task per split);
    * the initial shuffle partition count so that each reducer starts with
      about ``target_partition_bytes`` of shuffle data.  ``shuffle_fraction``
      is the share of the input that reaches a shuffle.  The jobs here shuffle
      projected columns after a map-side partial aggregate, so it is well under
      one; 0.25 is a conservative default.  AQE then coalesces small partitions
      and splits skewed ones at run time;
    * never fewer partitions than twice the cores, so every core stays busy.

    Example: 100 TB input, 4,000 cores -> about 100k initial shuffle partitions
    of ~256 MB each, which AQE coalesces where stages turn out smaller.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    partitions = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
