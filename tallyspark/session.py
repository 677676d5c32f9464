"""Session construction and the shared work folder.

Intermediate tables (upsert versions, landed sources, checkpoints) go under the folder the
cluster names in ``spark.checkpoint.dir``. Where it is unset, a ``local`` session gets one under
the system temp folder; on a cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tallyspark", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def cluster_settings(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of source data.

    Splits and shuffle partitions target ~256 MB each, so a task's working set stays well inside
    executor memory; AQE starts from that partition count and coalesces small stages down, and
    splits skewed partitions (>5x the median and >1 GB) of sort-merge joins.
    Example: 100 TB -> 409,600 initial shuffle partitions.
    """
    parts = max(200, input_bytes // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # broadcast only what is measured small: the static estimate and AQE's runtime size
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (time zone) and make sure a checkpoint dir exists."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    work_root(spark)
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; created only when the session has none."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return os.path.dirname(current.rstrip("/")) if _is_uuid_leaf(current) else current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tallyspark-ckpt-")      # one process: its own disk is shared
    if sc is not None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def session_key(spark: SparkSession) -> str:
    """Identity of a running application (for memoising lazily built plans)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return f"session-{id(spark)}"


def _is_uuid_leaf(path: str) -> bool:
    leaf = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(leaf)
        return True
    except ValueError:
        return False


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the work root (URI-style paths such as s3a:// are kept)."""
    root = work_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
