"""Spark session settings shared by jobs, tests and the bench.

Everything here is plain Spark configuration:

* UTC session time zone: the 30-day repeat window and every date→timestamp
  cast are epoch aligned, so results must not depend on the host zone.
* AQE on, with partition coalescing and skew-join splitting: shuffle sizes
  are decided at run time, and a hot join key is split instead of landing
  in one task.
* Broadcast joins only below an explicit size threshold, checked by the
  planner (statically, and again by AQE on real shuffle sizes); above it
  Spark falls back to a sort-merge join. The static check estimates a file
  scan from its file size, but Parquet decodes to several times that
  (3–7× on the test tables), so file sizes are scaled by
  ``FILE_EXPANSION_FACTOR`` before the comparison.
* Shuffle partitions are sized from the data: AQE can merge small shuffle
  partitions but never split a large one (except in skewed joins), so the
  initial count must be large enough for the biggest shuffle — the
  whole-row de-duplication of bookings moves about the whole table. Pass
  ``largest_shuffle_bytes`` and the count is chosen so that stage gets
  ``SHUFFLE_PARTITION_BYTES`` per task (100 TB → 204,800 partitions of
  512 MiB); AQE coalesces every smaller stage towards its advisory size.
* ANSI mode is left on (Spark 4 default); the code uses ``try_*`` functions
  where the reference relied on NULL-on-error behaviour.
* PySpark's per-call capture of the Python call site (used only to decorate
  error messages) is off: it costs several extra driver→JVM round trips for
  every column function, which dominates plan construction of wide plans.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Broadcast a join side only when its estimated size is below this bound.
BROADCAST_THRESHOLD_BYTES = 32 * 1024 * 1024
# In-memory size of decoded Parquet rows relative to the file size.
FILE_EXPANSION_FACTOR = 4.0
# Target bytes per task of the largest shuffle, and the advisory size AQE
# coalesces smaller shuffles towards.
SHUFFLE_PARTITION_BYTES = 512 * 1024 * 1024
ADVISORY_PARTITION_BYTES = 128 * 1024 * 1024

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_THRESHOLD_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_THRESHOLD_BYTES),
    "spark.sql.sources.fileCompressionFactor": str(FILE_EXPANSION_FACTOR),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_PARTITION_BYTES),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_partitions_for(largest_shuffle_bytes: int, per_task: int = SHUFFLE_PARTITION_BYTES) -> int:
    """Initial shuffle partition count so the largest shuffle of a job gets
    about ``per_task`` bytes per task (at least 1)."""
    return max(1, -(-int(largest_shuffle_bytes) // int(per_task)))


def get_session(
    master: str | None = None,
    app_name: str = "lodgepole",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    largest_shuffle_bytes: int | None = None,
) -> SparkSession:
    """Return a session with the engine's defaults.

    On a cluster, call without ``master`` and pass ``largest_shuffle_bytes``
    (about the size of the bookings table): the shuffle partition count is
    sized from it and AQE coalesces smaller stages by size rather than by
    parallelism. ``shuffle_partitions`` sets the count directly (tests).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if not master or not master.startswith("local"):
        # On a cluster, merge small shuffle partitions up to the advisory
        # size instead of keeping one per core.
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    if largest_shuffle_bytes and not shuffle_partitions:
        shuffle_partitions = shuffle_partitions_for(largest_shuffle_bytes)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra_conf:
        conf.update(extra_conf)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Session-level SQL settings also apply when the session already existed.
    for key in ("spark.sql.session.timeZone",):
        spark.conf.set(key, conf[key])
    return spark


def lake_root(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    This is the folder named by ``spark.checkpoint.dir``, which a cluster sets
    to shared storage; without it a cluster session fails here, because each
    executor would write to its own disk. Only a local master may run without
    it: a private folder is then made and registered as checkpoint directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that the driver and all executors share"
        )
    if context.applicationId not in _LOCAL_ROOTS:
        local = tempfile.mkdtemp(prefix="lodgepole-")
        context.setCheckpointDir(os.path.join(local, "_checkpoints"))
        _LOCAL_ROOTS[context.applicationId] = local
    return _LOCAL_ROOTS[context.applicationId]


_LOCAL_ROOTS: dict[str, str] = {}
