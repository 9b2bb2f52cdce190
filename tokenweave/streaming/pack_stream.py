"""Incremental packing with Structured Streaming.

The reference folds an ordered document stream into shards with carried
state (buffer, shard index, token count).  With the closed form of the cut,
the only state needed is the global offset of the next document.  Each
micro-batch (``foreachBatch``):

1. reads the carry row written by the batch before it,
2. checks that its documents come after that batch's last key,
3. encodes them and gives them offsets from that carry (a tree scan inside
   the batch, in ``doc_id`` order),
4. cuts them into shard segments and overwrites ``batch_id=<id>`` of the sink,
5. writes its own carry row.

Replaying a batch after a failure reads the same carry and overwrites the
same output, so the sink is exact once the query finishes.  A carry that is
missing or unreadable, a null key or a key that arrives out of order stops
the stream: a guess would lay documents over each other.  Null keys come last
in the order, so only a ``closing`` run takes them; no key may follow.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenweave.operators import packing, tokens
from tokenweave.plans.run import byte_offsets

DOC_SCHEMA = "doc_id bigint, text string"
CLOSED = (1 << 63) - 1  # last key after null keys
CARRY_SCHEMA = "batch_id bigint, carry_in bigint, carry_out bigint, last_key bigint"


def _carry_in(spark: SparkSession, carry_dir: str, batch_id: int) -> tuple[int, int | None]:
    """Offset and last key that the batch before left; only the first batch has none."""
    if batch_id == 0:
        return 0, None
    rows = spark.read.schema(CARRY_SCHEMA).parquet(f"{carry_dir}/batch_id={batch_id - 1}").collect()
    if len(rows) != 1:
        raise ValueError(f"batch {batch_id - 1} left {len(rows)} carry rows at {carry_dir}")
    return int(rows[0]["carry_out"]), rows[0]["last_key"]


def pack_batch(batch: DataFrame, batch_id: int, sink_dir: str, shard_size: int, closing: bool = False) -> None:
    """One micro-batch of the incremental packer (idempotent for a given batch_id)."""
    spark = batch.sparkSession
    carry_dir = f"{sink_dir}/_carry"
    carry, last_key = _carry_in(spark, carry_dir, batch_id)
    # the source is read once; checks, bounds and encoding work on the kept rows
    docs = (batch.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        lengths = tokens.byte_token_lengths(docs)
        first, last, nulls, added = lengths.agg(
            F.min("doc_id"), F.max("doc_id"), F.count(F.when(F.col("doc_id").isNull(), 1)),
            F.coalesce(F.sum("n"), F.lit(0))).first()
        if nulls and not closing:
            raise ValueError(f"batch {batch_id} has {nulls} documents without a key")
        if first is not None and last_key is not None and first <= last_key:
            raise ValueError(f"batch {batch_id} begins at key {first}, but key {last_key} is packed already")
        segs = packing.cut_segments(byte_offsets(docs).withColumn("off", F.col("off") + F.lit(carry)), shard_size)
        (segs.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").parquet(f"{sink_dir}/segments/batch_id={batch_id}"))
        key = CLOSED if nulls else last if last is not None else last_key
        (spark.createDataFrame([(batch_id, carry, carry + int(added), key)], CARRY_SCHEMA)
         .write.mode("overwrite").parquet(f"{carry_dir}/batch_id={batch_id}"))
    finally:
        docs.unpersist()


def pack_stream(spark: SparkSession, source_dir: str, sink_dir: str, shard_size: int,
                files_per_trigger: int | None = None, closing: bool = False) -> DataFrame:
    """Run the packer over the files in ``source_dir`` it has not packed yet (trigger ``availableNow``).

    Without ``files_per_trigger`` all new files are one batch, so their order among each other does not
    matter.  ``closing`` says that nothing comes after these files, so that null keys can be packed
    (as one batch: not with ``files_per_trigger``).  Returns the packed segments read back from the sink.
    """
    if closing and files_per_trigger is not None:
        raise ValueError("the closing files are one batch")
    stream = spark.readStream.schema(DOC_SCHEMA).option("recursiveFileLookup", "true")
    if files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    q = (stream.parquet(source_dir).writeStream
         .foreachBatch(lambda df, bid: pack_batch(df, bid, sink_dir, shard_size, closing))
         .option("checkpointLocation", f"{sink_dir}/_checkpoint")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"packing stream failed: {q.exception()}")
    return spark.read.parquet(f"{sink_dir}/segments")
