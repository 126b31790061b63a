"""Session construction and shared scratch locations."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every sparkops session relies on. Time zone is pinned so that
# date/weekday extraction does not depend on the machine it runs on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Most keys of a run-time Bloom filter (some 16 MB), which is sent to every executor.
FILTER_KEYS = 13_000_000


def get_session(master: str | None = "local[*]", shuffle_partitions: int | None = None,
                app_name: str = "sparkops", extra: dict | None = None,
                input_bytes: int | None = None, total_cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session with sparkops' base settings.

    On a cluster, pass ``master=None`` and let spark-submit decide. Shuffle
    partitions are set only if the caller gives them or ``input_bytes`` and
    ``total_cores``, by which :func:`scale_conf` sizes them and the splits;
    otherwise what the session or spark-submit configured stays.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if input_bytes is not None and total_cores is not None:
        conf.update(scale_conf(input_bytes, total_cores))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the data: about ``partition_bytes`` per shuffle
    partition (never fewer than 2 per core) and splits of 128-256 MB, so
    each task's share fits in executor memory and spills stay rare. AQE
    then coalesces small partitions and splits skewed ones at run time.

    Joins whose smaller side is filtered but too big to broadcast reduce the
    larger side before its shuffle by a run-time Bloom filter: for smaller
    sides of up to a hundredth of the input, at most ``FILTER_KEYS`` keys (some
    10 bits each), and larger sides of at least a partition a core.

    Example: 100 TB (1e14 bytes) on 1000 executors x 8 cores -> 372,530
    shuffle partitions of 256 MiB.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(min(partition_bytes, 256 << 20)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(input_bytes // 100),
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(min(total_cores * partition_bytes, input_bytes // 10)),
        "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": str(FILTER_KEYS // 4),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(FILTER_KEYS),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(10 * FILTER_KEYS),
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors: the session's checkpoint dir.

    It is read from ``spark.checkpoint.dir`` (or the SparkContext). Only a
    local-mode session (tests) without one gets a private folder, registered
    as its checkpoint dir; on a cluster a machine-local folder would not be
    visible to other executors, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="sparkops-ckpt-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused path below :func:`shared_dir` for one write."""
    return f"{shared_dir(spark)}/sparkops-scratch/{tag}-{uuid.uuid4().hex}"

