"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package relies on; all can change at run time.
RUNTIME_CONF = {
    # Trip times carry no zone. UTC keeps the implicit NTZ -> TIMESTAMP casts of
    # timestamp arithmetic free of daylight-saving gaps.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A written range of trips spans a month or two: no sort by month before the write.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


# Input bytes per shuffle partition before adaptive execution merges small ones.
BYTES_PER_PARTITION = 64 << 20


def configure(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to an existing session and return it.

    Adaptive execution merges shuffle partitions but starts from a fixed number,
    which at the default would leave hundreds of gigabytes in each at 100 TB. With
    ``input_bytes`` the start grows with the input; it is never lowered.
    """
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    present = int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = input_bytes // BYTES_PER_PARTITION
    if wanted > present:
        spark.conf.set(initial, str(wanted))
    return spark


def local_session(cpus: int = 8, app_name: str = "faregauge") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, private to this application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder: a machine-local path on a cluster would be
    lost with its executor.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_fallback:
            _local_fallback[context.applicationId] = tempfile.mkdtemp(prefix="faregauge-")
        base = _local_fallback[context.applicationId]
    return f"{base.rstrip('/')}/faregauge-{context.applicationId}"
