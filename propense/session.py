"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "propense", cores: int | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster passes its own session instead."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # A rule set or a profile is one wide aggregate; keep it compiled.
        .config("spark.sql.codegen.maxFields", "500")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PROPENSE_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the setting is absent on a local master is a temporary folder made; on a cluster a
    machine-local folder would be lost with its node, so that is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="propense-"))
        return sc.getCheckpointDir()
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage once, so that iterative work rereads it, not its joins."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read again, by column where that is enough."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
