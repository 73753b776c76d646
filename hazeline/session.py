"""Sessions for tests and benchmarks, and the shared scratch folder of a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "hazeline", **conf: str) -> SparkSession:
    """A one-machine session. On a cluster, pass the session the cluster gives you instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        # recording the Python call site of every column takes longer than many local queries
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the session's shared ``spark.checkpoint.dir``.

    Every executor must be able to read it, so a machine-local folder is only made up for a
    local session that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = spark.sparkContext.getCheckpointDir()
        if not root:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hazeline-"))
            root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Later branches then see the very same rows even if executors are lost in between.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
