"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.variant.allowDuplicateKeys": "true"}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results depend on: the UTC session zone, and that of repeated JSON fields the last counts."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "freshet") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config(map=SETTINGS)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_folder: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the cluster's shared folder (``spark.checkpoint.dir``, or the set checkpoint folder).

    Only in local mode, where all tasks share one machine, is a temporary folder
    made when none is named, one per application.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        base = _own_folder.setdefault(app, _own_folder.get(app) or tempfile.mkdtemp(prefix="freshet-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    The written table survives the loss of executors and is not recomputed by
    the several plans that read it.
    """
    path = shared_dir(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
