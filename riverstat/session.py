"""Session settings and the shared folder that checkpoints go to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "riverstat", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on (UTC wall clocks, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at the shared checkpoint folder the cluster names.

    Only a local session may fall back on a folder of its own: on a cluster a
    machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if sc.getCheckpointDir() is None:
        if not named:
            if not sc.master.startswith("local"):
                raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
            named = tempfile.mkdtemp(prefix="riverstat-checkpoint-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()
