"""Session helpers and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8, app: str = "claimtide") -> SparkSession:
    """Session for tests and timings on one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # small tables in as many splits as there are cores
        .config("spark.sql.files.openCostInBytes", "256k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only a local master may go without the setting; it gets a fresh folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="claimtide-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """Write a result once to the shared folder and go on from the files.

    Lost executors do not replay what led to it, later steps read only the
    columns they need, and Spark knows its size when it picks a join.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Tables written here give back the disk of their shuffles as soon as they are written.

    Spark else keeps them until the driver happens to collect its garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
