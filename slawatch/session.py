"""Spark session defaults and the shared checkpoint folder.

Everything in the library takes a ``SparkSession`` from the caller; this
module only offers a builder with the settings the jobs are written for
(AQE on, UTC session zone, no UI) and a helper that resolves the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Dynamic partition overwrite: a mart refresh replaces only the days it touched.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: Where the package lies.
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([*paths, ROOT])


def build_session(master: str | None = None, app_name: str = "slawatch",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir``, as set by the cluster).
    Only where it is unset in a single-process ``local[...]`` session, as in
    tests, a scratch folder is created and registered on the context; any
    other master without the setting is an error, since executors would
    write to their own disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # Unset in a single-process session (tests): a scratch folder.
        conf_dir = tempfile.mkdtemp(prefix="slawatch-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for staged tables)."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage by writing the rows as Parquet under the shared
    checkpoint folder and reading them back (never a local checkpoint).

    A written table survives lost executors like ``checkpoint()`` does, and
    later reads prune columns; it also avoids ``DataFrame.checkpoint()``
    failing in a session that has used an ``Observation``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


__all__ = ["build_session", "checkpoint_dir", "scratch_path", "cut_lineage", "workers_import",
           "DEFAULT_CONF"]
