"""Softmax, top-k per group, repeatable weighted draws, generation.

Draws are Gumbel-max over a hash: ``u = md5(seed|group|step|item)`` mapped
to (0, 1), key ``ln(w) - ln(-ln(u))``, winner ``max_by(item, key)``.  The
draw is a plain aggregate (partial per task), it is repeatable on any
cluster, and DuckDB computes the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenweave.functions.common import uniform_hash
from tokenweave.session import cut_lineage


def softmax_rows(df: DataFrame, col: str, out: str = "p") -> DataFrame:
    """G3 on an array column: ``exp(x - max) / sum(exp(x - max))`` per row.

    The row maximum and sum reach the element lambdas through ``zip_with``
    with ``array_repeat``: they are computed once per row.  Written as an
    outer column reference inside the lambda, Catalyst inlines the producer
    into the lambda body and the sum is recomputed for every element.
    """
    x = F.col(col)
    n = F.size(x)
    e = F.zip_with(x, F.array_repeat(F.array_max(x).cast("double"), n),
                   lambda v, m: F.exp(v.cast("double") - m))
    d = df.withColumn("_e", e)
    s = F.aggregate(F.col("_e"), F.lit(0.0), lambda a, v: a + v)
    d = d.withColumn(out, F.zip_with(F.col("_e"), F.array_repeat(s, F.size("_e")),
                                     lambda v, t: v / t))
    return d.drop("_e")


def softmax(df: DataFrame, group: list[str], score: str, out: str = "p") -> DataFrame:
    """G3 on a long table: softmax of ``score`` within each group (window form)."""
    w = Window.partitionBy(*group)
    e = F.exp(F.col(score).cast("double") - F.max(score).over(w))
    d = df.withColumn("_e", e)
    return d.withColumn(out, F.col("_e") / F.sum("_e").over(w)).drop("_e")


def topk(df: DataFrame, group: list[str], score: str, k: int, tie: str) -> DataFrame:
    """The ``k`` best rows per group, ties broken by ``tie`` ascending.

    ``row_number() <= k`` lets Spark insert a partial group limit before the
    shuffle, so a hot group sends at most k rows per task.
    """
    w = Window.partitionBy(*group).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn("rank_in_group", F.row_number().over(w)).filter(F.col("rank_in_group") <= k)


def gumbel_key(weight: Column, u: Column) -> Column:
    return F.log(weight) - F.log(-F.log(u))


def weighted_draw(df: DataFrame, group: list[str], item: str, weight: str, seed: str,
                  step: Column | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One item per group, drawn with probability proportional to weight.

    Weights need not sum to one (the reference does not renormalise the
    top-k probabilities; a multinomial draw does not need it).  ``carry``
    columns travel with the winning row.
    """
    step = step if step is not None else F.lit(0)
    u = uniform_hash(F.lit(seed), *[F.col(g) for g in group], step, F.col(item))
    d = df.withColumn("_key", gumbel_key(F.col(weight), u))
    if not carry:
        return d.groupBy(*group).agg(F.max_by(item, "_key").alias(item))
    won = d.groupBy(*group).agg(F.max_by(F.struct(item, *carry), "_key").alias("_w"))
    return won.select(*group, *[F.col(f"_w.{c}").alias(c) for c in (item, *carry)])


def next_token_topk(big: DataFrame, ctx: DataFrame, uni: DataFrame, N: int, V: int,
                    k: int) -> DataFrame:
    """G4 on the next-token table: ``(x, y, p)``, the ``k`` best targets of every context.

    For a context, an unobserved target scores its unigram half alone, so the
    best unobserved targets are among the ``k`` best unigram tokens.  The
    candidates are the observed pairs plus those ``k`` (attached with an
    ``explode`` of a k-element literal), never all of V; the result has at
    most ``contexts * k <= V * k`` rows, a bound set by parameters.
    """
    from tokenweave.functions.common import bounded_collect
    from tokenweave.operators.evaluate import prob

    top_uni = bounded_collect(uni.select("y", "cy").orderBy(F.desc("cy"), F.asc("y")).limit(k),
                              k, "unigram top-k")
    uni_lit = F.array(*[F.struct(F.lit(int(r["y"])).cast("bigint").alias("y"),
                                 F.lit(int(r["cy"])).cast("bigint").alias("cy"))
                        for r in top_uni])
    observed = big.join(F.broadcast(uni), "y").select("x", "y", "cxy", "cy")
    unseen = (ctx.select("x", F.explode(uni_lit).alias("u"))
              .select("x", F.col("u.y").alias("y"), F.lit(0).cast("bigint").alias("cxy"),
                      F.col("u.cy").alias("cy")))
    cand = (observed.unionByName(unseen)
            .groupBy("x", "y").agg(F.max("cxy").alias("cxy"), F.max("cy").alias("cy"))
            .join(ctx, "x", "left"))
    z = F.lit(0).cast("bigint")
    p = prob(F.col("cxy"), F.coalesce("cx", z), F.col("cy"), F.lit(N), V)
    return topk(cand.withColumn("p", p), ["x"], "p", k, "y").select("x", "y", "p")


UNSEEN_CONTEXT = -1


def unseen_context_rows(uni: DataFrame, N: int, V: int, k: int) -> DataFrame:
    """``(x = -1, y, p)``: candidates of a context never seen in training.

    Such a context scores every target by its unigram half alone, so its
    top-k are the k best unigram tokens.
    """
    pu = F.lit(0.5) * (F.col("cy") + 1).cast("double") / F.lit(float(N + V))
    best = topk(uni.withColumn("p", pu).withColumn("g", F.lit(0)), ["g"], "p", k, "y")
    return best.select(F.lit(UNSEEN_CONTEXT).cast("bigint").alias("x"), "y", "p")


def candidate_arrays(table: DataFrame) -> DataFrame:
    """``(x, cands)``: the candidates ``(y, p)`` of every context in one row (at most k entries)."""
    return table.groupBy("x").agg(F.collect_list(F.struct("y", "p")).alias("cands"))


def generate(prompts: DataFrame, table: DataFrame, num_sequences: int, max_length: int | None, seed: str,
             max_contexts: int = 65_537, checkpoint_every: int = 8, new_tokens: int | None = None) -> DataFrame:
    """``(item_id, seq, ids)``, each prompt continued to ``max_length`` ids, itself included, or by ``new_tokens``.

    Each prompt ``(item_id, ids)`` is replicated ``num_sequences`` times
    (explode, G1).  A step looks up the candidates of the last token (G2, G4),
    draws one (G5/G6) and appends it (G7), until the sequence has
    ``max_length`` ids; a longer prompt is cut to that length (with
    ``new_tokens`` every prompt is kept whole and continued).  A context has
    its candidates in one row, so a step is a lookup in a table of at most
    ``max_contexts`` rows (one per token id; its size is checked before it is
    broadcast, beyond it the lookup is a shuffle join) and a draw inside the
    row: no group, no hot key.  A context never seen in training, or an empty
    prompt, uses the rows ``x = -1``.
    """
    from tokenweave.functions.common import bounded_collect, broadcast_if_small

    rows = cut_lineage(candidate_arrays(table))
    unseen = bounded_collect(rows.where(F.col("x") == UNSEEN_CONTEXT).select(F.explode("cands").alias("c")).select("c.*"),
                             65_536, "candidates of an unseen context")
    fallback = F.array(*[F.struct(F.lit(int(r["y"])).cast("bigint").alias("y"), F.lit(float(r["p"])).alias("p")) for r in unseen])
    lookup = broadcast_if_small(rows, max_contexts)
    if (max_length is None) == (new_tokens is None):
        raise ValueError("give either max_length or new_tokens")
    own = F.col("ids") if max_length is None else F.slice("ids", 1, max_length)
    end = F.size(own) + new_tokens if max_length is None else F.lit(max_length)
    seqs = prompts.select("item_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(num_sequences - 1).cast("bigint"))).alias("seq"),
                          own.cast("array<bigint>").alias("ids"), end.alias("end"))
    steps = seqs.agg(F.max(F.col("end") - F.size("ids"))).first()[0] or 0
    for t in range(steps):
        x = F.get(F.col("ids"), F.size("ids") - 1)
        step = seqs.withColumn("x", x).join(lookup, "x", "left").withColumn("cands", F.coalesce("cands", fallback))
        key = lambda c: gumbel_key(c["p"], uniform_hash(F.lit(seed), F.col("item_id"), F.col("seq"), F.lit(t), c["y"]))  # noqa: B023, E731
        best = F.array_max(F.transform("cands", lambda c: F.struct(key(c).alias("key"), c["y"].alias("y"))))  # noqa: B023
        seqs = step.select("item_id", "seq", F.when(F.size("ids") < F.col("end"), F.concat("ids", F.array(best["y"])))
                           .otherwise(F.col("ids")).alias("ids"), "end")
        if (t + 1) % checkpoint_every == 0:
            seqs = cut_lineage(seqs)
    return seqs.drop("end")
