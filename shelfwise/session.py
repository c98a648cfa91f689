"""Session defaults and the shared folder for materialised intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew-join splitting on; ``conf`` overrides."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_local(master: str) -> None:
    """Raise unless all of Spark runs in this process."""
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` if the session names one.

    Only an unset session on this machine alone (tests, a laptop) gets a temporary folder: on a cluster
    each executor would write to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        require_local(spark.sparkContext.master)
        folder = tempfile.mkdtemp(prefix="shelfwise-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/shelfwise/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few files work for all cores; a scan with enough partitions stays as it is.

    For CPU-heavy row work on small inputs. ``df`` must be a plain scan: its partition count is
    then known without running anything, and at scale there is no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
