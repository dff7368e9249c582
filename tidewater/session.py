"""Session construction and the shared folder used for tables and checkpoints.

On a cluster ``spark.checkpoint.dir`` names a folder every executor can reach
(HDFS / object store). All written tables, streaming checkpoints and
``checkpoint()`` output go below it, never into a machine-local temp folder.
Only in local mode, where one machine is the whole cluster, may the setting be
absent; a session of its own folder is then made. On a cluster that is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for a scale run. AQE re-plans joins and shuffle sizes at runtime from
# real statistics; skew-join splits hot partitions; UTC keeps event-time windows
# aligned to wall-clock hours.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "tidewater",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_root(spark: SparkSession) -> str | None:
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    return sc.getConf().get("spark.checkpoint.dir", None)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a temp one only if unset."""
    root = _configured_root(spark)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tidewater-shared-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, kind: str, name: str) -> str:
    """A fresh, unique path below the shared folder, e.g. for one table or one stream."""
    return f"{shared_root(spark)}/tidewater/{kind}/{name}-{uuid.uuid4().hex[:12]}"


def parallelism(spark: SparkSession) -> int:
    """The session's shuffle parallelism (``spark.sql.shuffle.partitions``),
    which the operator sizes for the cluster and data; partition and bucket
    counts follow it instead of being fixed in code."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
