"""SparkSession helpers.

Only the settings a report job needs are set here; cluster-level settings
(executor sizes, checkpoint directory, shuffle service) belong to the
deployment and are read, never overwritten.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session settings every job relies on (semantics, not tuning).
_SEMANTIC_CONF = {
    # All date arithmetic is done on naive calendar dates/timestamps: the
    # TIMESTAMP type means wall-clock time (as in the source warehouse), so
    # results do not depend on the session or client time zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    # ANSI stays on: bad casts fail loudly unless a try_* function is used.
    "spark.sql.ansi.enabled": "true",
}

# Runtime re-planning: coalesce small shuffles, split skewed join partitions.
_ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "scorewatch") -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in {**_SEMANTIC_CONF, **_ADAPTIVE_CONF}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session (driver-created).

    The checkpoint directory is asked for when something is staged, not here:
    reports that stage nothing run without one.
    """
    for k, v in _SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    for k, v in _ADAPTIVE_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at storage that all machines
    share, whatever its scheme (a mounted folder is a ``file:`` path), and is
    used as is. Only when nothing is configured (local tests) a scratch
    directory is created.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared directory for this cluster")
    local = tempfile.mkdtemp(prefix="scorewatch-ckpt-")
    sc.setCheckpointDir(local)
    return local
