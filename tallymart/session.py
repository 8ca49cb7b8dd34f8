"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach: that of the setting, or one beside the warehouse."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def local_session(cores: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallymart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
