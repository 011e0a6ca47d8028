"""Sessions for local work, and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    app: str = "siltworks",
    cpus: str | int = "*",
    memory: str = "8g",
    shared: str | None = None,
) -> SparkSession:
    """A session for tests and benchmarks. Cluster jobs bring their own session."""
    shared = shared or tempfile.mkdtemp(prefix="siltworks-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config(CHECKPOINT_CONF, shared)
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _temporary_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"siltworks-{application}-")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then works in a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
        root = _temporary_root(spark.sparkContext.applicationId)
    return root.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute once and keep the rows in the shared folder, where a lost executor cannot take them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, read again with pruned columns."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
