"""Corpus scan.

The reference streams rows of a hosted dataset and reads only ``text``.  Here
the corpus is any table with an order key and a text column; Catalyst prunes
every other column at the scan and pushes the split filter into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenweave.functions.common import broadcast_if_small

READERS = ("parquet", "json", "csv", "orc")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


SPREAD_TASKS = 64


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread a scan that yields fewer tasks than the cluster has cores.

    A single-row-group file is read by one task however many executors
    exist; hashing it over the cores costs one small shuffle.  A real corpus
    (many files, many row groups) has more than ``SPREAD_TASKS`` splits, and
    then this is a no-op whatever the cluster's size: it is never reshuffled.
    """
    target = min(SPREAD_TASKS, df.sparkSession.sparkContext.defaultParallelism)
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def read_table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return spread(df, key) if key else df


FILES_BROADCAST = 500_000


def row_keys(spark: SparkSession, path: str) -> DataFrame:
    """S1/T2 without a key column: the parquet table at ``path`` with ``doc_id``, the row's place in the corpus.

    Files in the order of their names, rows in the order of their file, as an
    iterator over the files would give them.  The place comes from the scan's
    metadata columns, so it is the same on every run and however the files are
    split into tasks; only one row per file is ever in one task.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg((F.max("_row") + 1).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).cast("bigint").alias("_base"))
    found = rows.join(broadcast_if_small(bases, FILES_BROADCAST), "_file")
    own = [c for c in found.columns if c not in ("_file", "_row", "_base", "doc_id")]
    return found.select((F.col("_base") + F.col("_row")).alias("doc_id"), *own)


def read_corpus(spark: SparkSession, path: str, key: str | None = "doc_id", text: str = "text",
                where: Column | str | None = None, fmt: str = "parquet",
                schema: str | None = None) -> DataFrame:
    """Scan a corpus as ``(doc_id BIGINT, text STRING)``.

    ``where`` is the split choice at the source (S2), e.g. ``"lang = 'en'"``;
    it is applied before the projection so it reaches the scan as a pushed
    filter.  A null text is read as the empty string (it still yields the
    end-of-text token, as an empty document does).  Without a ``key`` the
    order is that of the files and their rows (parquet only).
    """
    if fmt not in READERS:
        raise ValueError(f"unsupported corpus format {fmt!r}; one of {READERS}")
    if key is None:
        if fmt != "parquet" or schema is not None:
            raise ValueError("a corpus without a key column is read from parquet")
        df = row_keys(spark, path)
        df = df if where is None else df.filter(where)
        return spread(df.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")), "doc_id")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("multiLine", "true").option("escape", '"')
    if fmt == "json":
        reader = reader.option("multiLine", "false")
    df = reader.format(fmt).load(path)
    if where is not None:
        df = df.filter(where)
    df = df.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return spread(df, "doc_id")


def corpus_scan(spark: SparkSession, sf_dir: str, where: Column | str | None = None) -> DataFrame:
    """The ``documents`` table as a corpus, with its size columns for reporting."""
    docs = read_corpus(spark, table_path(sf_dir, "documents"), where=where)
    return docs.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
    )
