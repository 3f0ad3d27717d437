"""Spark session and shared scratch locations.

Every job runs with the session time zone pinned to UTC (all trip times are
wall-clock values without a zone), ANSI mode left on, the UI off and adaptive
query execution on, so that shuffle partition counts, join strategies and
skewed partitions are re-planned at run time from real sizes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# No broadcast threshold is raised: Spark's default (10 MB) applies to size
# estimates, and AQE converts a join to broadcast only from measured sizes.


def build_session(
    master: str | None = None,
    app_name: str = "tripcraft",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session configured for the trip jobs.

    On a cluster leave ``master`` unset so spark-submit decides, and let AQE
    size shuffles; ``shuffle_partitions`` is the upper bound AQE coalesces from.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Session-level settings also apply when getOrCreate returned an old session.
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(key, conf[key])
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder for intermediate tables and stream checkpoints.

    Read from ``spark.checkpoint.dir``; only when a session with a local master
    has none (tests) a private folder is created and registered as the
    checkpoint dir. On a cluster that would be another disk on every machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
        except Exception:  # pragma: no cover - Spark Connect has no context
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share (master {master!r})")
        root = tempfile.mkdtemp(prefix="tripcraft-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # pragma: no cover
            pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one written table."""
    return f"{shared_root(spark)}/tripcraft/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    """Cores available to the job (falls back to the shuffle partition count)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # pragma: no cover - Spark Connect has no context
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
