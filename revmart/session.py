"""Session helpers: a configured session for local runs and the checkpoint
directory rule (the cluster's shared ``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "revmart", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def _current_checkpoint_dir(spark: SparkSession) -> str | None:
    opt = spark.sparkContext._jsc.sc().getCheckpointDir()
    return opt.get() if opt.isDefined() else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint`` has a reliable directory: the one
    already set, or the session's ``spark.checkpoint.dir``. A cluster without
    one is an error, since no folder of the driver's disk would do; a local
    session (one process, as in tests) gets a temporary folder.
    """
    cur = _current_checkpoint_dir(spark)
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="revmart-checkpoints-")
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir
