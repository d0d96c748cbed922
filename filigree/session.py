"""Session factory and shared settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "filigree") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df dealt to all cores where it comes in few splits, for work that costs far more than a row's way through a shuffle. Large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() <= 4 * cores else df


def kept(df: DataFrame) -> DataFrame:
    """df as written to the checkpoint folder that all executors share (a temporary one only where none is set)."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local") and not df.sparkSession.conf.get("spark.checkpoint.dir", None):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="filigree-"))
    return df.checkpoint()
