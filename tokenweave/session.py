"""Session helpers: a tuned local/test session and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on; cluster deployments pass the same keys
# through spark-submit and only the sizes change.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE coalesces small shuffle partitions towards this size and splits
    # skewed ones; on a cluster set spark.sql.shuffle.partitions high
    # (input bytes / 128 MB) and let AQE shrink it.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tokenweave", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the deployment and used as is.
    Only a session whose executors are threads of this process (``local``) gets
    a scratch folder where it is unset; any other raises.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="tokenweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    The frame is persisted first: an eager checkpoint runs one job to
    compute the rows and another to write them, and without the cache the
    second job would recompute the whole plan.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of the store that holds ``path``."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def folder_state(spark: SparkSession, path: str) -> tuple | None:
    """What tells one state of a table's folder from another: bytes, files and when it last changed; None if absent."""
    fs, at = hadoop_path(spark, path)
    if not fs.exists(at):
        return None
    content = fs.getContentSummary(at)
    return content.getLength(), content.getFileCount(), fs.getFileStatus(at).getModificationTime()
