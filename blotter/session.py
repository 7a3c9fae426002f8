"""Session construction and the shared scratch location for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at run time, so no job hard-codes reducer counts.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# With CSV column pruning on, DROPMALFORMED only checks the columns a query
# selects, so short or long rows survive a narrow select. The strict reader
# semantics need it off (see sources.delimited).
STRICT_MALFORMED_CONF = {"spark.sql.csv.parser.columnPruning.enabled": "false"}


def build_session(
    master: str | None = None,
    app_name: str = "blotter",
    shuffle_partitions: int | None = None,
    strict_malformed: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if strict_malformed:
        conf.update(STRICT_MALFORMED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared directory for intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a local-mode session
    without one (tests) gets a private temporary directory; on a cluster a
    machine-local folder would not be shared by the executors, so a missing
    setting is an error there.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if base is None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if configured is None and not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared directory (HDFS, object store) "
                "for intermediate tables"
            )
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="blotter-ckpt-"))
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under :func:`scratch_dir`."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


_KEPT: dict[str, list[str]] = {}
_LOCK = threading.Lock()


def kept_path(spark: SparkSession, name: str) -> str:
    """A :func:`scratch_path` that :func:`release_kept` removes: for files that a
    returned frame still reads."""
    path = scratch_path(spark, name)
    with _LOCK:
        _KEPT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_kept(spark: SparkSession) -> None:
    """Remove what this session's frames have written under :func:`kept_path`."""
    with _LOCK:
        paths = _KEPT.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
