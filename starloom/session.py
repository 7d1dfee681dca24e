"""Session settings the operators are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every operator assumes.  They are all run-time SQL settings, so
#: they can also be applied to a session somebody else started.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def get_session(app_name: str = "starloom", master: str | None = None, **conf) -> SparkSession:
    """Build (or reuse) a session with :data:`SQL_SETTINGS` applied.

    ``master`` stays unset on a cluster, where spark-submit decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``; only where
    that is unset and the master is local a temporary folder of the machine is used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"starloom-{purpose}-")
