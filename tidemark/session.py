"""Session settings for tests, the bench and notebooks. On a cluster the caller brings the session."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, memory: str = "12g", app: str = "tidemark") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A folder of this machine is used only when all executors are on this machine.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        import tempfile

        return os.path.join(tempfile.gettempdir(), "tidemark-checkpoints")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared folder, so that later steps read it instead of computing it again.

    The table is Parquet: what reads it takes the columns and the rows that it needs.
    """
    path = f"{shared_folder(df.sparkSession)}/tidemark-cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
