"""Session helpers: a local session for tests / bench, and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Makes Spark remove a query's shuffle files when it ends, instead of when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stratum", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster to be.

    On a real cluster the platform builds the session; nothing in the library
    depends on these settings except AQE being on (the Spark default).
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A session without one gets a private folder if its master is local, as in tests;
    on a cluster that folder would be another one on every machine, so there it is an error.
    """
    root = None
    try:
        root = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        root = None
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext (e.g. a Connect session)
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if not root:
            try:
                root = sc.getCheckpointDir()
            except Exception:
                root = None
    if not root and sc is not None and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="stratum-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def session_key(spark: SparkSession) -> str:
    """An id for the running application (for per-run memoisation)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return f"session-{id(spark)}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/stratum/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run within leave no shuffle files: a job of many writes holds those of one at a time on its disks."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for helpers that touch the local FS in tests)."""
    return path[len("file:"):] if path.startswith("file:") else path


def scale_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized to the data, for a cluster run.

    Shuffle partitions start at ~``partition_bytes`` of input each (AQE then
    coalesces small ones and splits skewed ones), never below three waves of
    the cluster's cores; scans read splits of the same size.  At 100 TB and
    256 MiB that is ~400k initial shuffle partitions, coalesced by AQE to the
    real post-filter volume.
    """
    partitions = max(3 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        # broadcast only what measures under this (Spark checks the size)
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
