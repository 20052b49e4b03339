"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session gets. AQE re-plans joins and shuffle partition
# counts at run time and splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _local_cores(master: str) -> int:
    """Threads of a ``local``, ``local[n]``, ``local[*]`` or ``local[n,f]`` master."""
    inner = master[len("local"):].strip("[]").split(",")[0]
    if inner == "*":
        return os.cpu_count() or 1
    return int(inner) if inner else 1


def build_session(app: str = "driftlog", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the common settings.

    ``master=None`` leaves the master to the launcher (``spark-submit`` or
    the cluster's configuration; plain ``python`` then runs ``local[*]``)
    and keeps the configured shuffle partition count. An explicit
    ``local[n]`` master (tests, bench, tools) gets one shuffle partition per
    core and a 16 GB driver.
    """
    builder = SparkSession.builder.appName(app)
    conf = dict(BASE_CONF)
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "16g"
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or _local_cores(master))
    elif shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to storage every executor and the
    driver can reach; a machine-local folder would lose state with the
    machine. Only a local-mode session (tests, the bench) gets a fresh
    temporary folder when the setting is missing.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    root = tempfile.mkdtemp(prefix="driftlog-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint root, e.g. for a streaming query."""
    return f"{checkpoint_root(spark)}/{name}"
