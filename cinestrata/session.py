"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "cinestrata", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small files keep all threads of one machine busy; a cluster keeps the default.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="cinestrata-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``checkpoint()`` and the tree learners a reliable folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def workspace(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the shared folder."""
    return f"{_workspaces(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _workspaces(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/cinestrata/{spark.sparkContext.applicationId}"


def drop_workspaces(spark: SparkSession) -> None:
    """Delete what this application has written under :func:`workspace` and nothing else.

    To be called when its frames are no longer read; a long application may call it between jobs.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_workspaces(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialised(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as parquet in the shared folder and read back.

    For frames that several later jobs read: they get column pruning, pushed filters
    and real sizes, and none of them repeats the work that made the frame.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
