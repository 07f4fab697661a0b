"""Session settings for local runs, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app_name: str = "obsloom", cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder: on a cluster other machines
    could not read it, so there a missing setting is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None)
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="obsloom-"))
    return context.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared work folder, never used by another run."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared work folder; what follows survives the loss of executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession))
    return df.checkpoint()
