"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "cutline") -> SparkSession:
    """Session for tests and benchmarks; on a cluster use the session the cluster hands out."""
    n = "8" if cpus == "*" else str(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="cutline-warehouse-"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in plain local mode without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="cutline-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder, so that later jobs see one fixed set of rows.

    Needed where a result is read twice and its values could differ in the last bits
    between evaluations (float sums after a shuffle). Later reads take only the columns they use.
    """
    path = f"{shared_folder(df.sparkSession)}/cutline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def default_slots(spark: SparkSession) -> int:
    """Number of value ranges for the two-level algorithms; grows with the cluster."""
    return max(16, min(10_000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
