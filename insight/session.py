"""Session construction and checkpoint-folder handling.

Operators never create sessions themselves; tests, the bench and the entry
module call :func:`build_session`. On a cluster the session comes from the
platform and only :func:`ensure_checkpoint_dir` is used.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = "local[8]", app: str = "insight",
                  shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, taking it from the session.

    ``spark.checkpoint.dir`` names the shared folder on a cluster. Only a
    local-mode session (tests, bench) without that setting gets a private
    temporary folder; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="insight-ckpt-")
        sc.setCheckpointDir(folder)
        return folder
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
