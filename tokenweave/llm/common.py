"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenweave.functions.common import broadcast_if_small, ship_by_value
from tokenweave.session import ensure_checkpoint_dir, hadoop_path

ship_by_value(__name__)

# Fixed value: a word is a maximal run of bytes other than space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(key: Column, mod: int) -> Column:
    """crc32 of the key written as text, modulo ``mod`` (a null key counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def shared_path(spark: SparkSession, what: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write a derived table to the shared folder once and read it back.

    One job computes and writes the rows (an eager checkpoint would run two), and a lost
    executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = shared_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(df: DataFrame, what: str) -> Iterator[DataFrame]:
    """``df`` written once and read back, for as long as it is in use; then its folder is deleted."""
    spark = df.sparkSession
    path = shared_path(spark, what)
    df.write.parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    fs, at = hadoop_path(spark, path)
    fs.delete(at, True)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows (views, nothing is copied)."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def drop_columns_ignoring_case(df: DataFrame, names: list[str]) -> DataFrame:
    """Input columns that an operator's output columns would clash with go."""
    low = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in low])


RUNS_BROADCAST = 500_000
COPIES_AT_ONCE = 65_536


def numbered_copies(df: DataFrame, keys: list[str], carry: dict[str, Column] | None = None) -> DataFrame:
    """Rows that agree in ``keys`` told apart by ``copy`` (from 0), so that a range sort can split them.

    Equal rows are counted before the shuffle and written out again in blocks.  ``carry`` names aggregates of
    columns that follow from the keys.
    """
    counted = df.groupBy(*keys).agg(F.count("*").alias("_copies"), *[c.alias(n) for n, c in (carry or {}).items()])
    blocks = counted.withColumn("_block", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {COPIES_AT_ONCE})")))
    return blocks.withColumn("copy", F.explode(F.expr(
        f"sequence(_block * {COPIES_AT_ONCE}, least(_copies, (_block + 1) * {COPIES_AT_ONCE}) - 1)"))).drop("_copies", "_block")


def place_in_groups(df: DataFrame, groups: list[str], order: list[str], what: str, weight: str | None = None) -> DataFrame:
    """``df`` with ``place``: how many rows (or how much ``weight``) of its group come before the row.

    Rows are range-sorted by group and order (nulls first) and written once, so a large group is spread over as many
    tasks as its share of the rows; each part then only needs the sum of the parts before it.  ``groups`` must not be
    null and ``order`` should tell a group's rows apart.
    """
    ranges = df.repartitionByRange(*groups, *order) if groups or order else df
    rows = materialise(ranges.sortWithinPartitions(*groups, *order).withColumn("_at", F.monotonically_increasing_id()), what)
    rows = rows.withColumn("_part", F.shiftright("_at", 33))  # the id is part and row in one number
    keys = [*groups, "_part"]
    size = F.count("*") if weight is None else F.sum(weight)
    runs = rows.groupBy(*keys).agg(F.min("_at").alias("_first"), size.cast("bigint").alias("_size"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select(*keys, "_first", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).cast("bigint").alias("_base"))
    if weight is None:
        inside = F.col("_at") - F.col("_first")
    else:
        before = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("_run", F.coalesce(F.sum(weight).over(before), F.lit(0)).cast("bigint"))
        inside = F.col("_run")
    joined = rows.join(broadcast_if_small(bases, RUNS_BROADCAST), keys)
    return joined.withColumn("place", F.col("_base") + inside).drop("_at", "_part", "_first", "_base", "_run")
