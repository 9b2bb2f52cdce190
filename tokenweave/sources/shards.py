"""Shard sink, shard discovery and shard load.

Shards are a partitioned parquet table ``split=…/shard_index=…`` whose rows
are segments ``(pos, doc_id, src, n, doc_n, data)``, their ids packed in 16 bits.  Discovery is a
partition-pruned scan of that table instead of a directory listing and a
substring test on file names.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenweave.functions.common import idiv, shard_label
from tokenweave.operators.tokens import assert_token_range
from tokenweave.params import check_split
from tokenweave.session import ensure_checkpoint_dir, hadoop_path


_MADE: list[tuple[str, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append((spark.sparkContext.applicationId, path))
    return path


def drop_scratch(spark: SparkSession, made: list[tuple[str, str]] | None = None) -> None:
    """Delete the folders that this session made, or only ``made``; tables that still read them are lost."""
    app = spark.sparkContext.applicationId
    for entry in list(_MADE) if made is None else made:
        if entry[0] == app and entry in _MADE:
            fs, at = hadoop_path(spark, entry[1])
            fs.delete(at, True)
            _MADE.remove(entry)


@contextmanager
def passing(spark: SparkSession, *names: str):
    """Folders of these names made inside are deleted at the end: steps on the way to a table that is then written."""
    before = set(_MADE)
    yield
    drop_scratch(spark, [m for m in _MADE if m not in before and m[1].rsplit("/", 1)[1].rsplit("-", 1)[0] in names])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table once below the shared folder and read it back.

    One job computes and writes the rows; a lost executor costs a re-read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Target tokens per written file (16-bit ids: about 8 MB before compression).
TOKENS_PER_FILE = 4_000_000


def write_shards(segments: DataFrame, path: str, shard_size: int,
                 files_per_shard: int | None = None, mode: str = "overwrite", in_order: bool = False) -> str:
    """Write segments as ``split=…/shard_index=…`` parquet.

    Rows are hash-partitioned on ``(shard_index, pos div chunk)``: a shard is
    bounded by S tokens, each writing task holds whole chunks of one shard,
    and a shard becomes ``files_per_shard`` files (by default one per
    ``TOKENS_PER_FILE`` tokens: a 1e8-token shard is written by 25 tasks)
    instead of one file per (task, shard).  No range sampling, so the
    upstream plan is not run twice.  The directory is created by the writer (S3).
    ``in_order``: each task has neighbouring documents already (as after
    ``ordered_offsets``), so a shard is written by the few tasks that hold a
    part of it and nothing is shuffled.
    """
    if files_per_shard is None:
        files_per_shard = max(1, -(-shard_size // TOKENS_PER_FILE))
    chunk = max(1, -(-shard_size // max(1, files_per_shard)))
    # nothing out of range reaches a shard (packed tokens were checked when they were packed)
    checked = assert_token_range(segments) if "ids" in segments.columns else segments
    placed = checked if in_order else checked.repartition(F.col("shard_index"), idiv(F.col("pos"), chunk))
    (placed.sortWithinPartitions("shard_index", "pos")
     .write.mode(mode).option("compression", "zstd").partitionBy("split", "shard_index").parquet(path))
    return path


def read_shards(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Segments of one split (partition pruning on ``split``)."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.filter(F.col("split") == check_split(split))
    return df


def list_shards(spark: SparkSession, path: str, split: str | None = None, prefix: str = "corpus",
                require: bool = True) -> DataFrame:
    """The shards of one split, or of both, in order, with their labels and sizes.

    Raises (S6) when the split has no shard, as the reference's loader does.
    """
    shards = (read_shards(spark, path, split)
              .groupBy("split", "shard_index")
              .agg(F.sum("n").cast("bigint").alias("n_tokens"))
              .withColumn("label", shard_label(prefix, F.col("split"), F.col("shard_index"))))
    if require and shards.limit(1).count() == 0:
        raise ValueError(f"the {split or 'shard'} table at {path} is empty")
    return shards.orderBy("split", "shard_index")


def load_shard_tokens(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Shard segments with their 16-bit ids widened to BIGINT, as the loader uses them."""
    from tokenweave.operators.packed import unpack

    rows = read_shards(spark, path, split)
    rows = unpack(rows) if "data" in rows.columns else rows
    return rows.withColumn("ids", F.col("ids").cast("array<bigint>"))
