"""Session settings, table loading and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings that results or plans depend on. Partition counts are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

STAR_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def tune(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "saltmill", **extra: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter makes it."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a local session without
    that setting falls back to a temporary folder, since there executor and
    driver are the same machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    """A folder for this process, deleted when it ends."""
    folder = tempfile.mkdtemp(prefix="saltmill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the scratch folder and read back: cuts lineage, survives lost executors.

    Zstandard instead of Spark's default: smaller, and its writers hold no direct buffers,
    which pile up outside of the heap over many short writes.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
