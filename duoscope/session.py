"""Session helpers: sane defaults for AQE, skew handling, Arrow and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "duoscope",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    On a cluster pass ``master=None``; the launcher decides. ``shuffle_partitions``
    should be sized so one shuffle partition is ~128-256 MB at the target scale.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Use the cluster's ``spark.checkpoint.dir``; only in local mode invent one.

    On a cluster the folder must be shared storage named by the cluster itself, so
    nothing is set there and ``None`` is returned when it is missing.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="duoscope-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
        return path
    return None


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss).

    A cluster that names no folder in ``spark.checkpoint.dir`` is an error: nothing else
    would keep the rows when an executor is lost.
    """
    if not ensure_checkpoint_dir(df.sparkSession):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return df.checkpoint(eager=eager)
