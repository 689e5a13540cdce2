"""Session helpers: build a session for tests/bench, and make sure a reliable
checkpoint directory exists before lineage is cut."""
from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_CKPT: dict[int, str] = {}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "runoff", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    On a cluster the directory must be configured (``spark.checkpoint.dir``,
    a shared file system); it is never invented there.  Only a local-mode
    session without one (tests, the bench) gets a fresh scratch directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running on a cluster")
    key = id(sc)
    if key not in _LOCAL_CKPT:
        _LOCAL_CKPT[key] = tempfile.mkdtemp(prefix="runoff-ckpt-")
    sc.setCheckpointDir(_LOCAL_CKPT[key])
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint directory for written phase tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


@contextmanager
def without_shuffles(spark: SparkSession):
    """What is written in here leaves no shuffle files behind: Spark else keeps
    them until the driver collects its garbage, beside those of later steps."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)
