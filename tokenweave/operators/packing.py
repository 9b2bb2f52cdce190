"""Shard cutting over global offsets.

The reference folds documents one by one into a 1e8-token buffer.  Here the
fold disappears: a document with ``n`` tokens starting at global offset
``off`` covers shards ``off div S .. (off+n-1) div S`` and fills
``[max(off, s*S), min(off+n, (s+1)*S))`` of shard ``s``, so cutting is one
``explode`` over a short sequence, all inside one codegen stage.

The offsets themselves are a running sum in ``doc_id`` order, made by the
tree scan of ``prefix.ordered_offsets``: a single ``sum() over (order by
doc_id)`` would move every document to one task.  Order: key, then length and
content among equal keys; null keys come last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenweave.functions.common import idiv, shard_label
from tokenweave.operators.packed import digests, id_at, take


def cut_segments(offsets: DataFrame, shard_size: int) -> DataFrame:
    """Cut every document at shard borders.

    Output ``(split, shard_index, pos, doc_id, src, n, doc_n, ids, first_id,
    last_id)``: ``pos`` is the place in the shard, ``src`` the place in the
    document, ``n`` the piece length, ``doc_n`` the whole document's length.  A document may span any number of shards (Q1) and a shard that
    fills exactly is never followed by an empty one (Q3, P6).
    """
    S = int(shard_size)
    d = offsets.withColumn("shard_index", F.explode(F.sequence(
        idiv(F.col("off"), S), idiv(F.col("off") + F.col("n") - 1, S))))
    a = F.greatest(F.col("off"), F.col("shard_index") * S)
    b = F.least(F.col("off") + F.col("n"), (F.col("shard_index") + 1) * S)
    cols = [
        F.when(F.col("shard_index") == 0, F.lit("val")).otherwise(F.lit("train")).alias("split"),
        F.col("shard_index").cast("bigint").alias("shard_index"),
        (a - F.col("shard_index") * S).cast("bigint").alias("pos"),
        F.col("doc_id"),
        (a - F.col("off")).cast("bigint").alias("src"),
        (b - a).cast("bigint").alias("n"),
        F.col("n").cast("bigint").alias("doc_n"),
    ]
    if "ids" in offsets.columns:
        cols += [F.slice("ids", (a - F.col("off") + 1).cast("int"), (b - a).cast("int")).alias("ids"),
                 # end tokens as scalars: the border pairs between segments then read
                 # two small columns instead of the token arrays
                 F.element_at("ids", (a - F.col("off") + 1).cast("int")).alias("first_id"),
                 F.element_at("ids", (b - F.col("off")).cast("int")).alias("last_id")]
    if "data" in offsets.columns:
        piece = take(F.col("data"), a - F.col("off"), b - a)
        cols += [piece.alias("data"), id_at(F.col("data"), a - F.col("off")).alias("first_id"),
                 id_at(F.col("data"), b - F.col("off") - 1).alias("last_id")]
    return d.select(*cols)


def shard_manifest(segments: DataFrame, prefix: str = "corpus") -> DataFrame:
    """One row per shard: label, tokens, pieces, first and last document."""
    return (segments.groupBy("split", "shard_index")
            .agg(F.sum("n").cast("bigint").alias("n_tokens"),
                 F.count(F.lit(1)).cast("bigint").alias("n_segments"),
                 F.min("doc_id").alias("first_doc"),
                 F.max("doc_id").alias("last_doc"))
            .withColumn("label", shard_label(prefix, F.col("split"), F.col("shard_index"))))


def shard_token_checksum(segments: DataFrame) -> DataFrame:
    """Per shard, a position-weighted checksum of the ordered token stream of packed segments.

    ``sum(id * ((pos + i) % 1009))`` over every token proves that each token
    sits at its place in the shard, without building the shard array.
    """
    sums = digests(segments.select("split", "shard_index", "pos", "n", "data"), {"checksum": ("data", "at"), "id_sum": ("data", "sum")})
    return sums.groupBy("split", "shard_index").agg(
        *[F.sum(c).cast("bigint").alias(o) for c, o in (("checksum", "checksum"), ("id_sum", "id_sum"), ("n", "n_tokens"))])


def segment_group_totals(segments: DataFrame) -> DataFrame:
    """E7 [re-aimed]: conditional totals, whole versus cut documents, per split."""
    whole = (F.col("src") == 0) & (F.col("n") == F.col("doc_n"))
    return (segments.groupBy("split")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_pieces"),
                 F.count(F.when(whole, 1)).cast("bigint").alias("n_whole"),
                 F.count(F.when(~whole, 1)).cast("bigint").alias("n_cut"),
                 F.sum(F.when(whole, F.col("n")).otherwise(0)).cast("bigint").alias("tokens_whole"),
                 F.sum(F.when(~whole, F.col("n")).otherwise(0)).cast("bigint").alias("tokens_cut")))
