"""E0-E8 [re-aimed]: a count-based next-token table and its cross-entropy.

The reference scores held-out batches with a neural network.  Here the
"model" is an interpolated bigram table Spark builds by aggregation:

    p(y | x) = 0.5 * c(x, y) / c(x)  +  0.5 * (c(y) + 1) / (N + V)

with ``c(x) = 0`` giving the unigram half alone.  Scoring is a join of
*aggregated* pairs (one row per distinct pair and batch) to the table, so a
frequent pair is one row, not millions; the unigram side is bounded by V.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenweave.functions.common import broadcast_if_small, idiv, ship_by_value
from tokenweave.sources.shards import written

ship_by_value(__name__)

# Distinct held-out pairs up to which the side that needs them is broadcast.
HELD_OUT_PAIRS = 2_000_000
STEPS_PER_BLOCK = 32  # neighbouring steps that one group scores, unless the caller knows their size
POINTS_PER_BLOCK = 32  # neighbouring evaluation points that one group works out
ALL = -1  # in place of a pair's x or y: summed over it


def ngram_tables(pair_counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(bigram, contexts, unigram, total)`` from ``(x, y, cnt)`` rows."""
    big = pair_counts.groupBy("x", "y").agg(F.sum("cnt").cast("bigint").alias("cxy"))
    ctx = big.groupBy("x").agg(F.sum("cxy").cast("bigint").alias("cx"))
    uni = big.groupBy("y").agg(F.sum("cxy").cast("bigint").alias("cy"))
    tot = uni.agg(F.coalesce(F.sum("cy"), F.lit(0)).cast("bigint").alias("N"))
    return big, ctx, uni, tot


def prob(cxy: Column, cx: Column, cy: Column, N: Column, V: int) -> Column:
    big = F.when(cx > 0, cxy.cast("double") / cx).otherwise(F.lit(0.0))
    return F.lit(0.5) * big + F.lit(0.5) * (cy + 1).cast("double") / (N + V).cast("double")


def ngram_model(big: DataFrame, ctx: DataFrame, uni: DataFrame, N: int, V: int) -> DataFrame:
    """E0 as one table: ``(x, y, cnt, p)`` for every observed pair."""
    m = big.join(ctx, "x").join(F.broadcast(uni), "y")  # unigram side: at most V rows
    return m.select("x", "y", F.col("cxy").alias("cnt"),
                    prob(F.col("cxy"), F.col("cx"), F.col("cy"), F.lit(N), V).alias("p"))


def score(pairs: DataFrame, big: DataFrame, ctx: DataFrame, uni: DataFrame, N: int,
          V: int, bounded: bool = False) -> DataFrame:
    """Add ``p`` and ``nll`` to aggregated pairs ``(keys..., x, y, cnt)``.

    ``pairs`` is already aggregated (one row per distinct pair and batch),
    so a frequent pair is one row on the probe side of the join.  With
    ``bounded`` (held-out batches: at most val_batches * ranks * B*T pairs)
    the model tables are first cut to the pairs needed by a broadcast semi
    join, so the full bigram table is scanned once and never shuffled.
    """
    if bounded:
        need = broadcast_if_small(pairs.select("x", "y").distinct(), HELD_OUT_PAIRS)
        big = big.join(need, ["x", "y"], "left_semi")
    s = (pairs.join(big, ["x", "y"], "left")
         .join(F.broadcast(ctx), "x", "left")  # contexts and targets: at most V rows each
         .join(F.broadcast(uni), "y", "left"))
    z = F.lit(0).cast("bigint")
    p = prob(F.coalesce("cxy", z), F.coalesce("cx", z), F.coalesce("cy", z), F.lit(N), V)
    return s.withColumn("p", p).withColumn("nll", -F.log(F.col("p"))).drop("cxy", "cx", "cy")


def mean_loss(scored: DataFrame, by: list[str]) -> DataFrame:
    """Token-weighted mean negative log-likelihood per group."""
    return scored.groupBy(*by).agg(
        (F.sum(F.col("nll") * F.col("cnt")) / F.sum("cnt")).alias("loss"))


def val_losses(scored: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Loss per (rank, batch), mean over batches per rank, mean over ranks."""
    per_batch = mean_loss(scored, ["rank", "batch_no"])
    per_rank = per_batch.groupBy("rank").agg(F.avg("loss").alias("loss"))
    overall = per_rank.agg(F.avg("loss").alias("loss"))
    return per_batch, per_rank, overall


def asof_cumulative(counts: DataFrame, points: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Counts summed over intervals ``eb < ei`` for every (key, ei) of ``points``.

    ``counts`` is ``(keys..., eb, c)`` (one row per key and interval); a
    running sum per key is carried to every evaluation point by an as-of
    lookup: interval rows at position ``eb+1`` and evaluation rows at ``ei``
    are unioned and ``last(cum, ignorenulls)`` fills the evaluation rows.  A
    window partition holds one key's intervals and points (at most 2(E+1)
    rows), so the work is linear in the inputs however many points there are.
    """
    upto = lambda *o: Window.partitionBy(*keys).orderBy(*o).rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.select(*keys, (F.col("eb") + 1).alias("at"), F.lit(0).alias("kind"),
                        F.sum("c").over(upto("eb")).cast("bigint").alias("cum"))
    ev = points.select(*keys, F.col("ei").alias("at"), F.lit(1).alias("kind"),
                       F.lit(None).cast("bigint").alias("cum"))
    u = cum.unionByName(ev).withColumn("v", F.last("cum", ignorenulls=True).over(upto("at", "kind")))
    return u.filter(F.col("kind") == 1).select(*keys, F.col("at").alias("ei"),
                                               F.coalesce("v", F.lit(0).cast("bigint")).alias(name))


def _block_kernel(margins: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for rb in batches:
            block, x, y, cnt = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in rb.columns)
            if not len(block):
                continue
            names, group = np.unique(block, return_inverse=True)
            sides = [(x, y)]
            if margins:
                all_ = np.full(len(x), ALL)
                sides += [(x, all_), (all_, y), (all_, all_)]
            for a, b in sides:
                code, at = np.unique((group << 34) | ((a + 1) << 17) | (b + 1), return_inverse=True)
                total = np.zeros(len(code), np.int64)
                np.add.at(total, at, cnt)
                yield pa.RecordBatch.from_arrays([pa.array(names[code >> 34]), pa.array(((code >> 17) & 0x1FFFF) - 1), pa.array((code & 0x1FFFF) - 1), pa.array(total)],
                                                 names=["block", "x", "y", "cnt"])
    return run


def block_pairs(pairs: DataFrame, per: int, margins: bool = False, only: DataFrame | None = None) -> DataFrame:
    """``(block, x, y, cnt)``: the pairs ``(step, x, y, cnt)`` of each ``per`` neighbouring steps, counted.

    ``margins`` adds the sums over y, over x and over both, with ``ALL`` in their place; ``only`` keeps its ``(x, y)``.
    Summed in the scan's tasks first, so that a pair is moved once for a block and task.
    """
    part = (pairs.select(idiv(F.col("step"), per).alias("block"), "x", "y", "cnt")
            .mapInArrow(_block_kernel(margins), "block bigint, x bigint, y bigint, cnt bigint"))
    if only is not None:
        part = part.join(broadcast_if_small(only.select("x", "y"), HELD_OUT_PAIRS), ["x", "y"], "left_semi")
    return part.groupBy("block", "x", "y").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def _pack_kernel(batches):
    import numpy as np
    import pyarrow as pa

    for rb in batches:
        block, step, x, y, cnt = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in rb.columns)
        if not len(step):
            continue
        order = np.argsort(step, kind="stable")
        first = np.flatnonzero(np.diff(step[order], prepend=step[order[0]] - 1))
        code = np.split(((x << 16) | y)[order].astype("<u4"), first[1:])
        own = np.split(cnt[order], first[1:])
        yield pa.RecordBatch.from_arrays([pa.array(block[order[first]]), pa.array(step[order[first]]), pa.array([c.tobytes() for c in code], pa.binary()),
                                          pa.array([c.tobytes() for c in own], pa.binary())], names=["block", "step", "codes", "cnts"])


def packed_steps(pairs: DataFrame, per: int) -> DataFrame:
    """``(block, step, codes, cnts)``: the pairs of a step, of one Arrow batch, in a row of two binary columns."""
    return (pairs.select(idiv(F.col("step"), per).alias("block"), "step", "x", "y", "cnt")
            .mapInArrow(_pack_kernel, "block bigint, step bigint, codes binary, cnts binary"))


def _by_step(table):
    """``(step, pair codes, counts)`` of the steps of a block, in order."""
    import numpy as np

    step = table.column("step").to_numpy()
    codes, cnts = (table.column(c).to_pylist() for c in ("codes", "cnts"))
    for s in np.unique(step):
        rows = np.flatnonzero(step == s)
        yield (int(s), np.concatenate([np.frombuffer(codes[i], "<u4") for i in rows]).astype(np.int64),
               np.concatenate([np.frombuffer(cnts[i], np.int64) for i in rows]))


def _losses(rows: list[tuple[int, float, int]]):
    import pyarrow as pa

    step, nll, cnt = zip(*rows) if rows else ((), (), ())
    return pa.table({"step": pa.array(step, pa.int64()), "nll": pa.array(nll, pa.float64()), "cnt": pa.array(cnt, pa.int64())})


def _scored_kernel(steps, pairs):
    import numpy as np

    code = (pairs.column("x").to_numpy() << 16) | pairs.column("y").to_numpy()
    order = np.argsort(code)
    code, nll = code[order], pairs.column("nll").to_numpy()[order]
    out = []
    for step, own, cnt in _by_step(steps):
        out.append((step, float((nll[np.searchsorted(code, own)] * cnt).sum() / cnt.sum()), int(cnt.sum())))
    return _losses(out)


def scored_steps(pairs: DataFrame, scored: DataFrame, per: int) -> DataFrame:
    """``(step, nll, cnt)``: what the pairs of each step score by ``scored``, the scored ``block_pairs`` of the same pairs.

    A block of steps meets its pairs in one group, so the pairs of a step are moved once, packed.
    """
    known = scored.select("block", "x", "y", "nll")
    return (packed_steps(pairs, per).groupBy("block").cogroup(known.groupBy("block"))
            .applyInArrow(_scored_kernel, "step bigint, nll double, cnt bigint"))


class Counts:
    """Pair counts with their margins, as arrays that grow step by step."""

    def __init__(self, x, y, cnt) -> None:
        import numpy as np

        pair = (x != ALL) & (y != ALL)
        code = (x[pair] << 16) | y[pair]
        self.order = np.argsort(code)
        self.code, self.xy = code[self.order], cnt[pair][self.order]
        self.x, self.y = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.x[x[(x != ALL) & (y == ALL)]] = cnt[(x != ALL) & (y == ALL)]
        self.y[y[(x == ALL) & (y != ALL)]] = cnt[(x == ALL) & (y != ALL)]
        self.n = int(cnt[(x == ALL) & (y == ALL)].sum())

    def nll(self, code, at, V: int):
        """The loss of pairs, given as codes and places in ``code``; the same formula as ``prob``."""
        import numpy as np

        cx = self.x[code >> 16]
        seen = np.divide(self.xy[at], cx, out=np.zeros(len(at)), where=cx > 0)
        return -np.log(0.5 * seen + 0.5 * (self.y[code & 0xFFFF] + 1) / (self.n + V))


def _online_kernel(V: int):
    def run(steps, base):
        import numpy as np

        have = Counts(*(base.column(c).to_numpy() for c in ("x", "y", "before")))
        out = []
        for step, own, cnt in _by_step(steps):
            at = np.searchsorted(have.code, own)
            out.append((step, float((have.nll(own, at, V) * cnt).sum() / cnt.sum()), int(cnt.sum())))
            for counts, place in ((have.xy, at), (have.x, own >> 16), (have.y, own & 0xFFFF)):
                np.add.at(counts, place, cnt)
            have.n += int(cnt.sum())
        return _losses(out)
    return run


def online_step_loss(train_pc_by_step: DataFrame, V: int, per: int = STEPS_PER_BLOCK) -> DataFrame:
    """E4 online: loss of each step's pairs under the table built from earlier steps.

    The reference logs a step's loss before that step's update.  Steps are
    taken in blocks of ``per``: the counts before a block are running sums over
    the blocks, one window partition a pair, context or target, with at most
    one row a block.  A block's group starts from them and goes through its
    steps in order, so the pairs of a step are moved once, packed, and no row
    per step and pair is joined.  A pair of a step may come in several rows.
    """
    upto = Window.partitionBy("x", "y").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = (block_pairs(train_pc_by_step, per, margins=True)
            .select("block", "x", "y", F.coalesce(F.sum("cnt").over(upto), F.lit(0)).cast("bigint").alias("before")))
    steps = (packed_steps(train_pc_by_step, per).groupBy("block").cogroup(base.groupBy("block"))
             .applyInArrow(_online_kernel(V), "step bigint, nll double, cnt bigint"))
    return mean_loss(steps, ["step"])


def _curve_kernel(E: int, per: int, V: int):
    def run(table):
        import numpy as np
        import pyarrow as pa

        block = table.column("block")[0].as_py()
        x, y, at, cnt = (table.column(c).to_numpy() for c in ("x", "y", "eb", "cnt"))
        start = at < 0
        have = Counts(x[start], y[start], cnt[start])
        pair = (x[start] != ALL) & (y[start] != ALL)
        weight = table.column("w").to_numpy()[start][pair][have.order]
        steps, losses = [], []
        for m in range(block * per, min(E, block * per + per - 1) + 1 if len(weight) else 0):
            steps.append(m)
            losses.append(float((weight * have.nll(have.code, np.arange(len(have.code)), V)).sum()))
            own = at == m
            a, b, c = x[own], y[own], cnt[own]
            both, only_x, only_y = (a != ALL) & (b != ALL), (a != ALL) & (b == ALL), (a == ALL) & (b != ALL)
            np.add.at(have.xy, np.searchsorted(have.code, (a[both] << 16) | b[both]), c[both])
            np.add.at(have.x, a[only_x], c[only_x])
            np.add.at(have.y, b[only_y], c[only_y])
            have.n += int(c[(a == ALL) & (b == ALL)].sum())
        return pa.table({"ei": pa.array(steps, pa.int64()), "loss": pa.array(losses, pa.float64())})
    return run


def val_curve(train_pc_by_step: DataFrame, val_pc: DataFrame, steps: int, every: int,
              V: int, per: int = POINTS_PER_BLOCK) -> DataFrame:
    """E5: val loss of the table built from steps ``< m``, for ``m`` in the schedule.

    Evaluation points are ``m = i*every`` for ``i = 0..E`` with ``m < steps``.
    A loss is a mean over batches and ranks, so a val pair enters it with one
    weight, whatever batches it is in: what is worked out at a point is one
    row per distinct val pair.  Train counts are summed per evaluation
    interval and restricted to the pairs, contexts and targets that the val
    batches need before they are moved (a set bounded by the val batches).
    The counts before each block of ``per`` points are an as-of lookup
    (``asof_cumulative``); a block's group starts from them and adds one
    interval after the other.  A pair of a step may come in several rows.
    """
    E = (steps - 1) // every if steps > 0 else 0
    size = val_pc.groupBy("rank", "batch_no").agg(F.sum("cnt").alias("size"))
    ranks = size.groupBy("rank").agg(F.count(F.lit(1)).alias("batches"))
    share = size.join(F.broadcast(ranks), "rank").join(F.broadcast(ranks.agg(F.count(F.lit(1)).alias("ranks"))))
    held = (val_pc.join(F.broadcast(share), ["rank", "batch_no"]).groupBy("x", "y")  # one row per val batch
            .agg(F.sum(F.col("cnt") / F.col("size") / F.col("batches") / F.col("ranks")).alias("w")))
    every_ = F.lit(ALL).cast("bigint")
    none = F.lit(None).cast("double").alias("w")
    keys = (held.unionByName(held.select("x", every_.alias("y"), none).distinct())
            .unionByName(held.select(every_.alias("x"), "y", none).distinct())
            .unionByName(held.select(every_.alias("x"), every_.alias("y"), none).distinct()))
    keys = written(keys, "held-out")

    counts = written(block_pairs(train_pc_by_step, every, margins=True, only=keys), "interval-counts")
    block = idiv(F.col("block"), per)
    pts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(E // per).cast("bigint")))
    before = asof_cumulative(counts.groupBy("x", "y", block.alias("eb")).agg(F.sum("cnt").alias("c")),
                             keys.select("x", "y", pts.alias("ei")), ["x", "y"], "cnt")
    base = before.join(keys, ["x", "y"]).select(F.col("ei").alias("block"), F.lit(-1).cast("bigint").alias("eb"), "x", "y", "cnt", "w")
    adds = counts.select(block.alias("block"), F.col("block").alias("eb"), "x", "y", "cnt", none)
    found = base.unionByName(adds).groupBy("block").applyInArrow(_curve_kernel(E, per, V), "ei bigint, loss double")
    return found.select((F.col("ei") * every).alias("step"), F.lit("val").alias("split"), "loss")


def eval_schedule(steps_df: DataFrame, every: int, ckpt_every: int, last_step: int) -> DataFrame:
    """evaluation steps (``step % every == 0``) and which of them save a checkpoint."""
    s = F.col("step")
    return (steps_df.filter(s % every == 0)
            .select("step", ((s > 0) & ((s % ckpt_every == 0) | (s == last_step))).alias("is_checkpoint")))


def lr_expr(step: Column, warmup: int, max_steps: int, max_lr: float, min_lr: float) -> Column:
    """Linear warm-up, cosine decay to ``min_lr``, floor after ``max_steps``."""
    at = step.cast("double")
    done = (at - warmup) / float(max(1, max_steps - warmup))
    share = F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * done))
    return (F.when(step < warmup, F.lit(max_lr) * (at + 1) / float(warmup))
            .when(step > max_steps, F.lit(min_lr))
            .otherwise(F.lit(min_lr) + share * (max_lr - min_lr)))


# The schedule's highest and lowest rate.
MAX_LR, MIN_LR = 6e-4, 6e-5


def lr_schedule(steps_df: DataFrame, warmup: int, max_steps: int, max_lr: float = MAX_LR,
                min_lr: float = MIN_LR) -> DataFrame:
    if not 0 < warmup <= max_steps:
        raise ValueError("warm-up must be within the run")
    return steps_df.select("step", lr_expr(F.col("step"), warmup, max_steps, max_lr, min_lr).alias("lr"))


def global_norm_clip(df: DataFrame, col: str, cap: float = 1.0) -> tuple[DataFrame, float]:
    """E8 [re-aimed]: global L2 norm over every vector, then scale to at most ``cap``.

    The norm is one scalar aggregate (partial sums per task); the scaling is
    a ``transform`` on every row.  Returns the scaled frame and the norm.
    """
    sq = F.aggregate(F.col(col), F.lit(0.0).cast("double"),
                     lambda a, v: a + v.cast("double") * v.cast("double"))
    norm = math.sqrt(df.agg(F.coalesce(F.sum(sq), F.lit(0.0))).first()[0])
    scale = min(1.0, cap / norm) if norm > 0 else 1.0
    out = df.withColumn(col, F.transform(F.col(col), lambda v: v.cast("double") * scale))
    return out, norm
