"""Session defaults and the shared folder used for checkpoints and streaming state."""
from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "assayer", shuffle_partitions: int | None = None,
                  memory: str | None = None) -> SparkSession:
    """A session with the settings the plans assume: AQE with skew-join splitting, UTC and Arrow."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         # Resampling and sweeps multiply small shuffled inputs; a low floor keeps them on all cores.
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if memory:
        b = b.config("spark.driver.memory", memory)
    return b.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    A cluster names a folder every executor can reach in that setting. Only where it is unset, as in a
    local test, a temporary folder is made and recorded in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="assayer-")
        spark.conf.set("spark.checkpoint.dir", root)
    unique = spark.sql("SELECT uuid() AS u").first()["u"]
    return f"{root.rstrip('/')}/{purpose}-{unique}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a reduced result to the shared folder and read it back.

    Cuts the lineage where an expensive result is used several times. The files outlive the executors that wrote them.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
