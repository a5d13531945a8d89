"""Session helpers: recommended settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job of this library should start with. Partition counts are left to AQE.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where an aggregate by the join key follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # Call-site capture triples the driver time of building wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "billproof", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RECOMMENDED_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared checkpoint folder. A local run without one (tests) gets a temporary folder, a cluster is refused."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = configured or tempfile.mkdtemp(prefix="billproof-checkpoint-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: later passes read the result, with its true size, not the inputs."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
