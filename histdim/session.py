"""Session helpers: one place for the configuration every job relies on.

On a cluster the session is built by the platform; ``ensure_checkpoint_dir``
only fills in ``spark.checkpoint.dir`` where it is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library's plans assume. AQE re-plans joins from measured shuffle
# sizes (runtime broadcast, skew split, partition coalescing). Skew splitting is
# forced even where it costs one more shuffle (a join feeding an aggregate on
# the same key, as in the debut load): that shuffle is only added when a
# partition is measured to be skewed. The session time zone is pinned so that
# DATE/TIMESTAMP casts agree with the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python stack capture on every Column call while plans are built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # staged intermediates go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "histdim", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    in local mode (tests) a fresh scratch folder is created and registered.
    On a cluster an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext handle
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    else:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder shared by all "
                               "executors (a machine-local scratch folder is only used in local mode)")
        conf_dir = tempfile.mkdtemp(prefix="histdim-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scale_settings(input_bytes: int, total_cores: int, shuffled_share: float = 0.25,
                   shuffle_partition_bytes: int = 1 << 30, scan_partition_bytes: int = 512 << 20) -> dict:
    """Shuffle and scan sizing for a cluster run over ``input_bytes``.

    Shuffle partitions follow the bytes left after filters and column pruning
    (``shuffled_share`` of the input), about one per
    ``shuffle_partition_bytes`` (at least 2 per core): 100 TB stays at some
    25,000 partitions, whose map statuses the driver can hold. Sorts and
    aggregates of that size spill; AQE coalesces small partitions and splits
    skewed ones from measured map output.
    """
    partitions = max(2 * total_cores, -(-int(input_bytes * shuffled_share) // shuffle_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes // 4),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(shuffle_partition_bytes),
    }
