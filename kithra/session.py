"""Session helpers: a local session for tests, and durable cut points."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str | int = 8, app: str = "kithra", **conf) -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="kithra-"), "kithra.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(home):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(home)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would be lost with the executor that wrote it.
    """
    context = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kithra-checkpoint-"))
        path = context.getCheckpointDir()
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a scan that has fewer splits than cores.

    Tables of a cluster's size have more splits and are left as they are.
    ``df`` must be a plain scan (its splits are known without running anything).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of iterative jobs, survives the loss of executors, and
    gives the planner real sizes for the steps that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
