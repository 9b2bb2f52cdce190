"""E4/E5 by blocks of steps, and the train plan read from the slots, against brute force."""

import math
import random

from pyspark.sql import functions as F

from conftest import exchange_inputs
from tokenweave.operators import batching, evaluate

V, STEPS = 12, 23
PAIRS = "step bigint, x bigint, y bigint, cnt bigint"


def _train(rng):
    """Pairs of every step; some come in two rows."""
    return [(s, rng.randrange(V), rng.randrange(V), rng.randint(1, 5)) for s in range(STEPS) for _ in range(9)]


def _nll(rows, x, y):
    cxy = sum(c for _, a, b, c in rows if (a, b) == (x, y))
    cx, cy, n = sum(c for _, a, _, c in rows if a == x), sum(c for _, _, b, c in rows if b == y), sum(r[3] for r in rows)
    return -math.log(0.5 * (cxy / cx if cx else 0.0) + 0.5 * (cy + 1) / (n + V))


def _mean(rows, own):
    return sum(_nll(rows, x, y) * c for *_, x, y, c in own) / sum(r[-1] for r in own)


def test_online_loss_over_blocks_of_steps(spark):
    rows = _train(random.Random(5))
    df = spark.createDataFrame(rows, PAIRS).repartition(5)
    for per in (1, 4, 100):
        got = {r.step: r.loss for r in evaluate.online_step_loss(df, V, per).collect()}
        assert len(got) == STEPS
        for s, loss in got.items():
            assert abs(loss - _mean([r for r in rows if r[0] < s], [r for r in rows if r[0] == s])) < 1e-9, (per, s)


def test_steps_scored_by_blocks_move_packed_pairs(spark):
    rows = _train(random.Random(6))
    df = spark.createDataFrame(rows, PAIRS).repartition(4)
    big, ctx, uni, _ = evaluate.ngram_tables(df)
    scored = evaluate.score(evaluate.block_pairs(df, 6), big, ctx, uni, sum(r[3] for r in rows), V)
    steps = evaluate.scored_steps(df, scored, 6)
    got = {r.step: r.loss for r in evaluate.mean_loss(steps, ["step"]).collect()}
    assert len(got) == STEPS
    for s, loss in got.items():
        assert abs(loss - _mean(rows, [r for r in rows if r[0] == s])) < 1e-9, s
    # the pairs of a step are moved packed
    assert any("codes" in columns for _, columns in exchange_inputs(steps))


def test_val_curve_has_one_weight_per_val_pair(spark):
    rng = random.Random(7)
    rows = _train(rng)
    held = {(rank, b, rng.randrange(V), rng.randrange(V)): rng.randint(1, 4) for rank in (0, 1) for b in range(2 + rank) for _ in range(8)}
    val = spark.createDataFrame([(*k, c) for k, c in held.items()], "rank bigint, batch_no bigint, x bigint, y bigint, cnt bigint")
    df = spark.createDataFrame(rows, PAIRS).repartition(5)
    for per in (2, 100):
        got = {r.step: r.loss for r in evaluate.val_curve(df, val, STEPS, 3, V, per).collect()}
        assert sorted(got) == list(range(0, STEPS, 3))
        for m, loss in got.items():
            before = [r for r in rows if r[0] < m]
            ranks = [[_mean(before, [(*k, c) for k, c in held.items() if k[:2] == (rank, b)]) for b in range(2 + rank)] for rank in (0, 1)]
            assert abs(loss - sum(sum(r) / len(r) for r in ranks) / 2) < 1e-9, (per, m)


def test_val_curve_without_val_or_train_pairs(spark):
    val = "rank bigint, batch_no bigint, x bigint, y bigint, cnt bigint"
    some = spark.createDataFrame([(0, 1, 2, 3)], PAIRS)
    assert evaluate.val_curve(some, spark.createDataFrame([], val), 7, 3, V).count() == 0
    got = evaluate.val_curve(some.limit(0), spark.createDataFrame([(0, 0, 1, 2, 3)], val), 7, 3, V).collect()
    assert sorted((r.step, round(r.loss, 9)) for r in got) == [(m, round(math.log(2 * V), 9)) for m in (0, 3, 6)]


def test_planned_reads_equal_the_plan(spark):
    BT, P = 4, 3
    sizes = {1: 61, 2: 61, 3: 30}
    lengths = spark.createDataFrame([("train", k, n) for k, n in sizes.items()], "split string, shard_index bigint, L bigint")
    slots = spark.createDataFrame([("train", k, s, bytes([k, s])) for k, n in sizes.items() for s in range(-(-n // BT))],
                                  "split string, shard_index bigint, slot bigint, buf binary")
    for steps in (1, 3, 8):  # up to several epochs
        plan = batching.accumulation_plan(batching.batch_schedule(lengths, BT, P), steps, 2, P)
        want = sorted(tuple(r) for r in plan.select("rank", "batch_no", "shard_index", "slot").collect())
        reads = batching.planned_reads(slots, lengths, BT, P, steps * 2)
        assert sorted(tuple(r) for r in reads.select("rank", "batch_no", "shard_index", "slot").collect()) == want
        found = reads.select("shard_index", "slot", F.hex("buf").alias("h")).distinct().collect()
        assert all(r.h == bytes([r.shard_index, r.slot]).hex().upper() for r in found)
