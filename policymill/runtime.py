"""Session set-up, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "policymill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC, adaptive execution, Arrow."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; one of this machine only where Spark runs in this process."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = getattr(shared_dir, "own", None) or tempfile.mkdtemp(prefix="policymill-")
        shared_dir.own = at  # type: ignore[attr-defined]
    return at.rstrip("/")


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage is cut and the rows survive lost executors.

    With `by` each value of that column has a folder of its own, so a filter on it reads no other.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
