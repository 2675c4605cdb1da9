"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: AQE with skew-join splitting, UTC, no UI server.
# Broadcasts are Spark's own choice: by file size when planning, by the measured
# bytes of a finished stage at run time (spark.sql.autoBroadcastJoinThreshold).
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "packlift", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A cluster names it; only in a local session, where it may be unset, a fresh
    scratch folder is created and set. Elsewhere an unset folder is refused:
    every node would write to a disk of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master is {sc.master})")
        path = tempfile.mkdtemp(prefix="packlift-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: all
    later uses read the stored copy, also after an executor is lost."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/packlift-scope/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
