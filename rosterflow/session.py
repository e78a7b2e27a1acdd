"""Session settings the library is tuned for."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def recommended_conf() -> dict[str, str]:
    """Settings worth having on any cluster.

    Adaptive execution does two jobs here: it splits skewed partitions of the
    sort-merge joins, and it sizes the shuffle partitions.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "static",
    }


def build_session(app: str = "rosterflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :func:`recommended_conf`; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in recommended_conf().items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session takes a folder within its warehouse; a cluster
    session is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame, name: str = "frame") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later jobs then read only the columns and row groups they need, and the loss of
    an executor does not bring back the joins behind the frame.  The files stay
    until :func:`release` or the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.materialized_at = path
    return written


def release(*frames: DataFrame) -> None:
    """Delete the files of frames that :func:`materialize` gave; nothing may read them any more."""
    for frame in frames:
        spark, path = frame.sparkSession, frame.materialized_at
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
