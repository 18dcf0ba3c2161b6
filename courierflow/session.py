"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in this package relies on; all can change at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # merge the events of a session on the map side, before the shuffle by key
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def local_session(cores: int | str = 8, app: str = "courierflow", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="courierflow-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Where that is not set, the session's warehouse folder, which they share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared root; nothing is created or removed."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: the plan starts anew from a
    table that survives lost executors, and later passes do not repeat the work."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
