"""Strided next-token batches for P readers, as table arithmetic.

The reference's loader walks a shard with a cursor: rank ``r`` starts at
``r*BT`` and advances ``BT*P``; it leaves a shard when the *next* step would
overrun it.  That walk has a closed form.  For a shard of ``L`` tokens rank
``r`` gets

    nb = max(1, (L - 1 - r*BT) div (BT*P))

batches, batch ``j`` reading ``[ (r + j*P)*BT, (r + j*P)*BT + BT ]``.  Rank
``r`` is served only if its first buffer fits (``r*BT + BT + 1 <= L``); the
reference crashes otherwise, here the shard is skipped for that rank and
reported by ``dropped_tail`` (Q6).

The token work is one shuffle for all queries: every segment is cut into the
BT-token *slots* it touches (slot ``k`` = positions ``[k*BT, k*BT+BT]``, one
token of overlap for the shifted target), regrouped by ``(shard_index, slot)``
- a group of at most BT+1 tokens, however skewed the corpus is - and written
as a table clustered by shard and slot.  A batch is a row of that table: which
rank reads it and when is arithmetic on its slot and a lookup in a table with
one row per (rank, shard), so batch queries are narrow scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenweave.functions.common import broadcast_if_small, idiv, ship_by_value
from tokenweave.operators.packed import flat_ids, joined, slices, take

ship_by_value(__name__)

# A plan row is ~40 bytes: 2M rows stay well under the broadcast budget.
PLAN_BROADCAST_ROWS = 2_000_000
TOKENS_PER_BLOCK = 4_000_000  # of neighbouring slots that stay together in a file


def shard_lengths(segments: DataFrame) -> DataFrame:
    """``(split, shard_index, L)``: one row per shard."""
    return segments.groupBy("split", "shard_index").agg(F.sum("n").cast("bigint").alias("L"))


def _nb(L: Column, r: Column, BT: int, P: int) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), idiv(L - 1 - r * BT, BT * P))


def rank_shards(lengths: DataFrame, BT: int, P: int) -> DataFrame:
    """B1/B2/B6 per (rank, shard): batches served and whether the shard is too short.

    Ranks come from ``explode(sequence(0, P-1))`` on the shard table (P rows
    per shard), not from a join.
    """
    d = lengths.withColumn("rank", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                        F.lit(P - 1).cast("bigint"))))
    short = F.col("rank") * BT + BT + 1 > F.col("L")
    return d.select("split", "shard_index", "rank", "L",
                    F.when(short, F.lit(0).cast("bigint"))
                    .otherwise(_nb(F.col("L"), F.col("rank"), BT, P)).alias("nb"),
                    short.alias("too_short"))


def rank_prefix(lengths: DataFrame, BT: int, P: int) -> DataFrame:
    """``rank_shards`` with ``first_batch``: the rank's batches before the shard (B8), where it is served at all.

    The window is over the shard-level table (one row per rank and shard).
    """
    w = (Window.partitionBy("split", "rank").orderBy("shard_index")
         .rowsBetween(Window.unboundedPreceding, -1))
    rs = rank_shards(lengths, BT, P).withColumn("first_batch", F.coalesce(F.sum("nb").over(w), F.lit(0)).cast("bigint"))
    return rs.filter(F.col("nb") > 0)


def batch_schedule(lengths: DataFrame, BT: int, P: int) -> DataFrame:
    """``(rank, batch_no, shard_index, j, slot, start)`` for one epoch.

    ``batch_no`` runs across the split's shards in shard order.
    """
    b = rank_prefix(lengths, BT, P).withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nb") - 1)))
    slot = F.col("rank") + F.col("j") * P
    return b.select("split", "rank", (F.col("first_batch") + F.col("j")).alias("batch_no"),
                    "shard_index", "j", slot.alias("slot"), (slot * BT).alias("start"))


def locate_batches(wanted: DataFrame, lengths: DataFrame, BT: int, P: int) -> DataFrame:
    """Where any running batch number is read, without a schedule: ``wanted`` with ``epoch``, ``shard_index``, ``slot``.

    The inverse of the schedule.  Shards of a split but its last have one length, so a rank's batches in each are as
    many and the shard is a division; a table with one row per rank (the split's full shards and its last one) is all
    that is looked up.  ``wanted`` is ``(split, rank, batch_no, ...)``; numbers past one epoch wrap.
    """
    last = F.max(F.struct("shard_index", "L"))
    shape = lengths.groupBy("split").agg(F.min("shard_index").alias("first"), F.count(F.lit(1)).alias("shards"), last["L"].alias("L"),
                                         F.min(F.struct("shard_index", "L"))["L"].alias("full_L"),
                                         F.max("L").alias("most"), F.sum("L").alias("sum_L"))
    even = F.col("sum_L") == F.col("full_L") * (F.col("shards") - 1) + F.col("L")
    shape = shape.filter(F.assert_true(even & (F.col("most") == F.col("full_L")), F.lit("shards before the last must have one length")).isNull())
    tail = rank_shards(shape.select("split", F.col("first").alias("shard_index"), "L"), BT, P)
    full = rank_shards(shape.select("split", F.col("first").alias("shard_index"), F.col("full_L").alias("L")), BT, P)
    ranks = (full.select("split", "rank", F.col("nb").alias("nb_full"), F.col("shard_index").alias("first"))
             .join(tail.select("split", "rank", F.col("nb").alias("nb_last")), ["split", "rank"])
             .join(shape.select("split", "shards"), "split")
             .withColumn("per_epoch", F.col("nb_full") * (F.col("shards") - 1) + F.col("nb_last")).filter("per_epoch > 0"))
    at = wanted.join(F.broadcast(ranks), ["split", "rank"])  # at most two splits times P rows
    local = F.col("batch_no") % F.col("per_epoch")
    shard = F.least(idiv(local, F.greatest(F.col("nb_full"), F.lit(1))), F.col("shards") - 1)
    at = at.withColumn("nth", shard).withColumn("j", local - shard * F.col("nb_full"))
    return at.select(*wanted.columns, idiv(F.col("batch_no"), F.col("per_epoch")).alias("epoch"),
                     (F.col("first") + F.col("nth")).cast("bigint").alias("shard_index"), (F.col("rank") + F.col("j") * P).alias("slot"))


def epoch_totals(schedule: DataFrame) -> DataFrame:
    """Batches per rank in one pass over the split."""
    return schedule.groupBy("split", "rank").agg(F.count(F.lit(1)).cast("bigint").alias("per_epoch"))


def wrap_batches(schedule: DataFrame, wanted: DataFrame) -> DataFrame:
    """Map running batch numbers onto the cyclic schedule.

    ``wanted`` is ``(split, rank, batch_no)`` with any batch numbers; each is
    served by schedule row ``batch_no % per_epoch`` in epoch
    ``batch_no div per_epoch``.
    """
    tot = epoch_totals(schedule)
    w = (wanted.join(tot, ["split", "rank"])
         .withColumn("epoch", idiv(F.col("batch_no"), F.col("per_epoch")))
         .withColumn("local_no", F.col("batch_no") % F.col("per_epoch")))
    sched = schedule.withColumnRenamed("batch_no", "local_no")
    return w.join(sched, ["split", "rank", "local_no"]).drop("per_epoch")


def slot_table(segments: DataFrame, BT: int) -> DataFrame:
    """``(split, shard_index, slot, buf)`` with ``buf`` = BT+1 packed tokens from ``slot*BT`` (fewer at a shard's end).

    Each segment is cut to the slots it touches; the regroup is a bounded
    group (BT+1 tokens).  Neighbouring slots go to one task, so that the
    written table is clustered.
    """
    first = F.when(F.col("pos") == 0, F.lit(0).cast("bigint")).otherwise(idiv(F.col("pos") - 1, BT))
    last = idiv(F.col("pos") + F.col("n") - 1, BT)
    d = segments.select("split", "shard_index", "pos", "n", "data", F.explode(F.sequence(first, last)).alias("slot"))
    lo = F.greatest(F.col("pos"), F.col("slot") * BT)
    hi = F.least(F.col("pos") + F.col("n"), F.col("slot") * BT + BT + 1)
    block = idiv(F.col("slot"), max(1, TOKENS_PER_BLOCK // BT))
    d = d.select("split", "shard_index", block.alias("block"), "slot", lo.alias("p"), take(F.col("data"), lo - F.col("pos"), hi - lo).alias("piece"))
    # rows of a block meet in one task, which then needs no further exchange to group its slots
    return (d.repartition("split", "shard_index", "block").groupBy("split", "shard_index", "block", "slot")
            .agg(joined("piece", "p").alias("buf")).drop("block"))


def write_slots(segments: DataFrame, BT: int, path: str) -> str:
    """The slot table as parquet, by split and sorted by shard and slot."""
    (slot_table(segments, BT).sortWithinPartitions("split", "shard_index", "slot")
     .write.mode("overwrite").option("compression", "zstd").partitionBy("split").parquet(path))
    return path


def batches(slots: DataFrame, lengths: DataFrame, BT: int, P: int) -> DataFrame:
    """``(split, rank, batch_no, shard_index, slot, x, y)`` of one epoch, packed; y = x shifted by one.

    A narrow pass over the slot table: rank and batch follow from the slot and
    the (rank, shard) table.
    """
    served = broadcast_if_small(rank_prefix(lengths, BT, P).select("split", "shard_index", "rank", "nb", "first_batch"), PLAN_BROADCAST_ROWS)
    s = (slots.withColumn("rank", F.col("slot") % P).withColumn("j", idiv(F.col("slot"), P))
         .join(served, ["split", "shard_index", "rank"]).filter(F.col("j") < F.col("nb")))
    return s.select("split", "rank", (F.col("first_batch") + F.col("j")).alias("batch_no"), "shard_index", "slot",
                    take(F.col("buf"), 0, BT).alias("x"), take(F.col("buf"), 1, BT).alias("y"))


def batch_rows(batch_df: DataFrame, B: int, T: int) -> DataFrame:
    """Reshape every batch to B rows of T tokens."""
    rows = F.array(*[F.struct(take(F.col("x"), i * T, T).alias("x"), take(F.col("y"), i * T, T).alias("y")) for i in range(B)])
    d = batch_df.select(*[c for c in batch_df.columns if c not in ("x", "y")], F.posexplode(rows).alias("row", "r"))
    return d.select(*[c for c in d.columns if c != "r"], F.col("r.x").alias("x"), F.col("r.y").alias("y"))


def _pair_kernel(keys: list[str]):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for rb in slices(batches, len(keys)):  # the buffer is the last column
            ids, starts, n = flat_ids(rb.column(len(keys)))
            if not len(n):
                continue
            own = [rb.column(rb.schema.get_field_index(k)) for k in keys]
            first: dict = {}
            named = zip(*[c.to_pylist() for c in own]) if own else [()] * len(n)
            group = np.array([first.setdefault(k, (len(first), i))[0] for i, k in enumerate(named)], np.int64)
            # every place but the last of a row is a pair's x
            at = np.delete(np.arange(len(ids)), (starts + n - 1)[n > 0])
            pairs = np.maximum(n - 1, 0)
            code, count = np.unique((np.repeat(group, pairs) << 32) | (ids[at] << 16) | ids[at + 1], return_counts=True)
            rows = np.array([i for _, i in first.values()], np.int64)[code >> 32]
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(rows)) for c in own), pa.array((code >> 16) & 0xFFFF), pa.array(code & 0xFFFF), pa.array(count, pa.int64())],
                names=[*keys, "x", "y", "cnt"])
    return run


def pair_rows(planned: DataFrame, *keys: str) -> DataFrame:
    """``(keys..., x, y, cnt)``: next-token pairs inside the buffers ``buf``, counted in the scan's tasks, a slice of rows at a time.

    A narrow pass: a pair of one key may come in several rows.
    """
    fields = {f.name: f.dataType.simpleString() for f in planned.schema}
    schema = ", ".join([*(f"{k} {fields[k]}" for k in keys), "x bigint, y bigint, cnt bigint"])
    return planned.select(*keys, "buf").mapInArrow(_pair_kernel(list(keys)), schema)


def pair_counts(planned: DataFrame, *keys: str) -> DataFrame:
    """``pair_rows`` summed to one row per key and pair; only counts are shuffled."""
    return pair_rows(planned, *keys).groupBy(*keys, "x", "y").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def planned_slots(slots: DataFrame, plan: DataFrame, *keys: str) -> DataFrame:
    """The buffers of every planned batch ``(split, shard_index, slot, keys...)``; a slot planned twice comes twice.

    The plan has one row per batch: broadcast when it is small enough, so the
    slot table is scanned where it lies.
    """
    sel = broadcast_if_small(plan.select("split", "shard_index", "slot", *keys), PLAN_BROADCAST_ROWS)
    return slots.join(sel, ["split", "shard_index", "slot"])


def planned_reads(slots: DataFrame, lengths: DataFrame, BT: int, P: int, planned: int) -> DataFrame:
    """The slots with ``rank`` and ``batch_no``, once for each of a rank's first ``planned`` batches that reads them.

    What ``planned_slots`` finds by a join with one row per batch, from the (rank, shard) table: batch ``n`` of a rank
    is its schedule row ``n % per_epoch``, so a slot is read by every ``per_epoch``-th batch from its first on.
    """
    prefix = rank_prefix(lengths, BT, P)
    total = prefix.groupBy("split", "rank").agg(F.sum("nb").cast("bigint").alias("per_epoch"))
    served = broadcast_if_small(prefix.join(total, ["split", "rank"])
                                .select("split", "shard_index", "rank", "nb", "first_batch", "per_epoch"), PLAN_BROADCAST_ROWS)
    s = (slots.withColumn("rank", F.col("slot") % P).withColumn("j", idiv(F.col("slot"), P))
         .join(served, ["split", "shard_index", "rank"]).filter(F.col("j") < F.col("nb")))
    s = s.withColumn("first", F.col("first_batch") + F.col("j")).filter(F.col("first") < planned)
    numbers = F.sequence(F.col("first"), F.lit(planned - 1).cast("bigint"), F.col("per_epoch"))
    return s.select("split", "shard_index", "slot", "rank", F.explode(numbers).alias("batch_no"), "buf")


def dropped_tail(lengths: DataFrame, BT: int, P: int) -> DataFrame:
    """Per (rank, shard): batches served, where the rank stops, tokens it never reads."""
    rs = rank_shards(lengths, BT, P)
    next_start = (F.col("rank") + F.col("nb") * P) * BT
    return rs.select("split", "shard_index", "rank", "L", "nb", "too_short",
                     F.when(F.col("too_short"), F.lit(None).cast("bigint"))
                     .otherwise(next_start).alias("stop_at"))


def _wanted(schedule: DataFrame, count: int, ranks: int) -> DataFrame:
    """``(split, rank, batch_no)`` for the first ``count`` batch numbers of every rank, made by many tasks."""
    spark = schedule.sparkSession
    rank = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(ranks - 1).cast("bigint")))
    numbers = spark.range(count).select(F.col("id").alias("batch_no"), rank.alias("rank"))
    return numbers.join(F.broadcast(schedule.select("split", "rank").distinct()), "rank")  # at most 2 * ranks rows


def accumulation_plan(schedule: DataFrame, steps: int, accum: int, ranks: int) -> DataFrame:
    """Micro-batches of ``steps`` optimizer steps, ``accum`` per step per rank.

    Batch numbers past one epoch wrap around the split (B7).
    """
    plan = wrap_batches(schedule, _wanted(schedule, steps * accum, ranks))
    return plan.select("split", "rank", "batch_no",
                       idiv(F.col("batch_no"), accum).alias("step"),
                       (F.col("batch_no") % accum).alias("micro_step"),
                       "epoch", "shard_index", "slot")


def tokens_per_step(plan: DataFrame, BT: int) -> DataFrame:
    """Tokens of every step; a planned batch has BT of them, so no token is read."""
    return plan.groupBy("step").agg((F.count(F.lit(1)) * BT).cast("bigint").alias("tokens"))


def val_plan(schedule: DataFrame, val_batches: int, ranks: int) -> DataFrame:
    """The first ``val_batches`` batches of every rank after a reset."""
    return wrap_batches(schedule, _wanted(schedule, val_batches, ranks)).select("split", "rank", "batch_no", "epoch",
                                                 "shard_index", "slot")
