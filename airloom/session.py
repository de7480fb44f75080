"""Session settings and the shared scratch folder that stage tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "airloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library expects; explicit ``conf`` wins.

    On a cluster leave ``master`` unset and size ``spark.sql.shuffle.partitions`` for the
    largest shuffle: AQE merges small partitions but cannot split an undersized count.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A window by (city, block) must not settle for rows that lie together by city alone.
        "spark.sql.requireAllClusterKeysForDistribution": "true",
        # Streaming state may exceed executor memory.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # A batch then uploads its changes instead of whole state files.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for stage tables: ``spark.checkpoint.dir`` as the cluster names it.

    Unset is accepted in local mode only, where driver and executors share one disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts lineage at a durable table: lost executors re-read it rather than recompute the
    upstream plan, its columns still prune, and its size is known to the join planner.
    """
    path = f"{scratch_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)  # no direct buffers, which many small tasks add up
    return df.sparkSession.read.schema(df.schema).parquet(path)
