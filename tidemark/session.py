"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are planned for; `conf` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a new one in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application; nothing is created yet.

    The folder of an application may be removed once it has ended.
    """
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Later reads see fixed rows, survive the loss of executors, and carry true sizes for the
    planner. Used where two branches of a plan must agree on non-repeatable row positions.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
