"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Strict casts must fail the job and tolerant ones are written as try_*.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tables bucketed by hospital also serve joins on (hospital, month) without an exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(app: str = "wardlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """The settings results and plans rely on, for a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only a session with a local master, whose tasks share the driver's disk, gets a folder of its
    own when it names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(
                "set spark.checkpoint.dir (or --work) to a folder that the whole cluster shares; "
                f"with master {master} the driver's own disk will not do"
            )
        root = tempfile.mkdtemp(prefix="wardlens-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what a run wrote, through Spark's file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for plans that are read many times (iterative fits)."""
    spark = df.sparkSession
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint()
