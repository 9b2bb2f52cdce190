import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seqref import loader_batches
from tokenweave.operators import batching
from tokenweave.operators.packed import pack, unpack


def lengths_df(spark, shard_lengths, split="train"):
    return spark.createDataFrame([(split, i, L) for i, L in enumerate(shard_lengths)],
                                 "split string, shard_index bigint, L bigint")


# FIXTURES.md section 4, loader cases: (L, BT, P, batches by rank)
LOADER_CASES = [
    ("plain", 25_000, 256, 4, [24, 24, 23, 23]),
    ("exact fit for rank 0", 41, 4, 2, [5, 4]),
    ("one batch only", 9, 4, 2, [1, 1]),
    ("too short for rank 1", 8, 4, 2, [1, 0]),
]


@pytest.mark.parametrize("name,L,BT,P,expect", LOADER_CASES, ids=[c[0] for c in LOADER_CASES])
def test_loader_fixtures(spark, name, L, BT, P, expect):
    rs = batching.rank_shards(lengths_df(spark, [L]), BT, P).orderBy("rank").collect()
    assert [r.nb for r in rs] == expect
    assert [r.too_short for r in rs] == [n == 0 for n in expect]


def test_schedule_matches_sequential_loader(spark):
    rng = random.Random(11)
    B, T, P = 2, 4, 3
    BT = B * T
    shard_lengths = [rng.randint(5, 140) for _ in range(9)]
    sched = batching.batch_schedule(lengths_df(spark, shard_lengths), BT, P)
    need = 60
    wanted = sched.select("split", "rank").distinct().withColumn(
        "batch_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(need - 1).cast("bigint"))))
    got = batching.wrap_batches(sched, wanted).select("rank", "batch_no", "shard_index", "start").collect()
    by_rank = {}
    for r in got:
        by_rank.setdefault(r.rank, []).append((r.batch_no, r.shard_index, r.start))
    for rank in range(P):
        want = loader_batches(shard_lengths, B, T, P, rank, need)
        if want is None:
            assert rank not in by_rank
            continue
        assert [(s, st) for _, s, st in sorted(by_rank[rank])] == want, rank


def test_batches_equal_sliced_stream(spark, tmp_path):
    """x/y equal direct slices of the shard stream, across segment borders; so do the pairs."""
    rng = random.Random(5)
    S, B, T, P = 50, 2, 3, 2
    BT = B * T
    stream = [rng.choice([0, 1, 2, 65_535]) for _ in range(S)]
    cuts = sorted(rng.sample(range(1, S), 9))
    bounds = [0] + cuts + [S]
    segs = [("train", 1, a, b - a, stream[a:b]) for a, b in zip(bounds, bounds[1:])]
    seg_df = pack(spark.createDataFrame(segs, "split string, shard_index bigint, pos bigint, n bigint, ids array<int>"))
    lengths = batching.shard_lengths(seg_df)
    slots = spark.read.parquet(batching.write_slots(seg_df, BT, str(tmp_path / "slots")))
    assert [r.slot for r in slots.orderBy("slot").collect()] == list(range(-(-S // BT)))
    rows = unpack(unpack(batching.batches(slots, lengths, BT, P), "x", "x"), "y", "y").collect()
    sched = batching.batch_schedule(lengths, BT, P)
    where = ["rank", "batch_no", "shard_index", "slot"]
    assert rows and sorted(tuple(r[c] for c in where) for r in rows) == sorted(tuple(r) for r in sched.select(*where).collect())
    for r in rows:
        start = r.slot * BT
        assert list(r.x) == stream[start:start + BT]
        assert list(r.y) == stream[start + 1:start + BT + 1]
    # a slot planned twice counts twice
    plan = sched.unionByName(sched.where("batch_no = 0"))
    got = {tuple(r) for r in batching.pair_counts(batching.planned_slots(slots, plan, "batch_no"), "batch_no").collect()}
    want = Counter((r.batch_no, x, y) for r in rows for x, y in zip(r.x, r.y) for _ in range(2 if r.batch_no == 0 else 1))
    assert got == {(*k, c) for k, c in want.items()}
    total = Counter()
    for (_, x, y), c in want.items():
        total[x, y] += c
    assert {tuple(r) for r in batching.pair_counts(batching.planned_slots(slots, plan)).collect()} == {(*k, c) for k, c in total.items()}


def test_slots_of_a_segment_longer_than_many_slots(spark):
    """One segment over all slots, one of single tokens: the same table."""
    stream = list(range(100, 171))
    whole = [("val", 0, 0, 71, stream)]
    single = [("val", 0, i, 1, [t]) for i, t in enumerate(stream)]
    got = []
    for rows in (whole, single):
        df = pack(spark.createDataFrame(rows, "split string, shard_index bigint, pos bigint, n bigint, ids array<int>").repartition(3))
        got.append({r.slot: list(r.ids) for r in unpack(batching.slot_table(df, 8), "buf").collect()})
    assert got[0] == got[1] == {k: stream[8 * k:8 * k + 9] for k in range(9)}


@pytest.mark.parametrize("shards", [[40], [40, 40, 40, 17], [40, 40, 9], [40, 40, 3], [8, 8]])
def test_any_batch_is_located_without_the_schedule(spark, shards):
    BT, P = 4, 3
    lengths = lengths_df(spark, shards)
    sched = batching.batch_schedule(lengths, BT, P)
    per = batching.epoch_totals(sched)
    wanted = per.select("split", "rank", F.explode(F.expr("sequence(0L, 3 * per_epoch - 1)")).alias("batch_no"))
    got = sorted(tuple(r) for r in batching.locate_batches(wanted, lengths, BT, P).collect())
    at = {(r.rank, r.batch_no): (r.shard_index, r.slot) for r in sched.collect()}
    n = {r.rank: r.per_epoch for r in per.collect()}
    assert got == sorted(("train", r, b, b // n[r], *at[r, b % n[r]]) for r in n for b in range(3 * n[r])) and (got or shards == [8, 8])


def test_located_shards_must_be_even(spark):
    wanted = spark.createDataFrame([("train", 0, 0)], "split string, rank bigint, batch_no bigint")
    with pytest.raises(Exception, match="one length"):
        batching.locate_batches(wanted, lengths_df(spark, [40, 30, 40]), 4, 2).collect()


def test_batch_rows_reshape(spark):
    df = pack(pack(spark.createDataFrame([(0, list(range(12)), list(range(1, 13)))], "batch_no bigint, x array<int>, y array<int>"), "x", "x"), "y", "y")
    rows = unpack(unpack(batching.batch_rows(df, 3, 4), "x", "x"), "y", "y").orderBy("row").collect()
    assert [list(r.x) for r in rows] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11]]
    assert [list(r.y) for r in rows] == [[1, 2, 3, 4], [5, 6, 7, 8], [9, 10, 11, 12]]


def test_accumulation_plan_steps(spark):
    sched = batching.batch_schedule(lengths_df(spark, [1000, 1000]), 8, 2)
    plan = batching.accumulation_plan(sched, steps=5, accum=4, ranks=int(sched.selectExpr('max(rank) + 1').first()[0])).collect()
    assert len(plan) == 5 * 4 * 2
    for r in plan:
        assert r.step == r.batch_no // 4 and r.micro_step == r.batch_no % 4


def test_slot_regroup_is_bounded_and_partition_pruned(spark, tmp_path):
    from conftest import exchange_inputs, formatted_plan
    from tokenweave.sources import shards as shard_io

    segs = pack(spark.createDataFrame(
        [("val", 0, 0, 0, 0, 5, 5, [1, 2, 3, 4, 5]), ("train", 1, 0, 1, 0, 6, 6, [1, 2, 3, 4, 5, 6])],
        "split string, shard_index bigint, pos bigint, doc_id bigint, src bigint, n bigint, doc_n bigint, ids array<int>"))
    path = shard_io.write_shards(segs, str(tmp_path / "shards"), 10)
    train = shard_io.read_shards(spark, path, "train")
    assert "PartitionFilters: [isnotnull(split" in formatted_plan(train)
    # one shuffle, by blocks of slots, regroups the bounded slots too
    shuffles = [a for a, _ in exchange_inputs(batching.slot_table(train, 4)) if "hashpartitioning" in a]
    assert len(shuffles) == 1 and "block" in shuffles[0]
    assert [r.split for r in shard_io.list_shards(spark, path, "val").collect()] == ["val"]
