"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


# What a task should get out of a shuffle, with room to sort it in memory.
SHUFFLE_BYTES_PER_TASK = 128 * 2**20


def build_session(
    app_name: str = "marquee",
    master: str | None = None,
    largest_shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the jobs here rely on.

    Adaptive execution does the sizing: it coalesces small shuffle partitions,
    splits skewed ones, and turns a join into a broadcast only when the
    measured size of a side is below the threshold. No code in the package
    forces a broadcast.

    Adaptive execution can merge shuffle partitions but starts from a fixed
    number of them. For large tables give ``largest_shuffle_bytes``, the most
    that one join or sort is expected to move (compressed), to have enough.
    Streams are not affected; their state keeps ``spark.sql.shuffle.partitions``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Also where splitting a hot title costs one more shuffle afterwards.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # Titles are rewritten as a whole, so the whole table is replaced.
        "spark.sql.sources.partitionOverwriteMode": "static",
        # Running totals hold one entry per voted title, off the JVM heap.
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        # A batch stores what it changed, which readers of the state can ask for.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    if largest_shuffle_bytes is not None:
        partitions = max(200, math.ceil(largest_shuffle_bytes / SHUFFLE_BYTES_PER_TASK))
        settings.setdefault(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
        )
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path for intermediate tables and stream checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir`` so that a
    lost executor loses no data. Without that setting a local temporary folder is
    used in local mode, as in a unit test; on a cluster its executors would each
    write to a disk of their own, so there it is an error. Nothing is removed
    here: whoever owns the shared folder clears ``marquee/`` in it, best by age.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if re.fullmatch(r"local(\[.*\])?", master) is None:
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        base = tempfile.mkdtemp(prefix="marquee-")
    return f"{base.rstrip('/')}/marquee/{label}-{uuid.uuid4().hex}"
