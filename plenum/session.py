"""Spark sessions and the tables that jobs hand on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the submitter's settings hold instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plenum")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share: below spark.checkpoint.dir, or temporary in a local session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        root = tempfile.mkdtemp(prefix="plenum-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root}/plenum-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: the end of a lineage that a lost executor can't take back."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Fewer rows an Arrow batch from now on: ten thousand texts, held by the JVM and by Python, are too many."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))
