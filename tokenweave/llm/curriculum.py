"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time ``t`` in [0, 1], linear from ``start`` to
``end``.  Its integral is the cumulative demand for the source's words; inverting it turns an
offset in the source's word stream into the training position at which the word is due.
Documents are then range-sorted by position.

Scale: one narrow pass counts words per (source, bucket) with partial sums; a second pass ranks
documents inside (source, bucket) windows, so a source with a third of all rows is spread over
``buckets`` windows.  Bucket bases are one window over at most ``sources * buckets`` rows.

Defined cases: a null text or a text without words has size 0 and takes 0 words; a null source is a
source of its own, last in order; a row without ``doc_id`` is ordered by its text, so that many of them are
spread like others; repeated rows are documents of their own; an empty table gives an empty result; input columns named like an output
column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenweave.functions.common import bounded_collect, idiv
from tokenweave.llm.common import WORD, drop_columns_ignoring_case, materialise

OUT = ["size", "source_size", "target", "taken", "epochs", "first_position", "last_position"]


@dataclass(frozen=True)
class MixParams:
    """``weights`` repeat over the sources in order; ``max_epochs`` bounds repeats of a source.

    ``drift``: a source's schedule runs from ``1 - d`` to ``1 + d`` times its mean weight, the
    values of ``drift`` repeating over the sources.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    max_epochs: int = 3
    drift: tuple[float, ...] = (0.5, -0.5)
    buckets_hex: int = 3
    max_sources: int = 100_000


def reshare(sizes: list[int], weights: list[int], cap: int) -> list[Fraction]:
    """Targets that share ``sum(sizes)`` by weight, none above ``cap`` times its size.

    What a capped source leaves is shared again by weight among the others until none is above.
    """
    rest, open_ = Fraction(sum(sizes)), list(range(len(sizes)))
    out = [Fraction(0)] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] > cap * sizes[i] * total]
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / total
            return out
        for i in over:
            out[i] = Fraction(cap * sizes[i])
        rest -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def position(offset: Column, total: Column, drift: Column) -> Column:
    """Training time at which ``offset`` of ``total`` words is due.

    Demand up to ``t`` is ``total * ((1 - d) t + d t^2)``, the integral of the schedule
    ``1 - d + 2 d t``; this is its inverse, written so that it is exact for ``d = 0`` too.
    """
    u = F.when(total > 0, offset / total).otherwise(F.lit(0.0))
    a = F.lit(1.0) - drift
    return F.when(u > 0, 2 * u / (a + F.sqrt(a * a + 4 * drift * u))).otherwise(F.lit(0.0))


def mix(docs: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with the words that the mix takes of each and their training positions.

    Adds ``size``, ``source_size``, ``target`` (of the source), ``taken`` (words, repeats counted; the
    last document of a source's last pass is cut so that a source's words sum to its target, rounded
    down), ``epochs`` (passes begun), ``first_position`` and ``last_position`` (null if nothing is taken).
    """
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit("")).cast("binary"))
    base = drop_columns_ignoring_case(docs, [c for c in OUT if c not in (id_col, text_col, source_col)])
    sized = (base.withColumn("_mix_size", word_count(F.col(text_col)))
             .withColumn("_mix_key", key)
             .withColumn("_mix_bucket", F.substring("_mix_key", 1, params.buckets_hex)))
    buckets = materialise(
        sized.groupBy(F.col(source_col).alias("_mix_source"), "_mix_bucket")
        .agg(F.sum("_mix_size").alias("_mix_sum")), "mix-buckets")
    per_source = buckets.groupBy("_mix_source").agg(F.sum("_mix_sum").alias("n"))
    rows = bounded_collect(per_source, params.max_sources, "sources of a mix")
    # UTF-8 bytes sort like code points
    rows = sorted(rows, key=lambda r: (r[0] is None, (r[0] or "").encode()))
    sizes = [r[1] for r in rows]
    weights = [params.weights[i % len(params.weights)] for i in range(len(rows))]
    targets = reshare(sizes, weights, params.max_epochs)
    plan = docs.sparkSession.createDataFrame(
        [(r[0], n, float(t), int(t), float(params.drift[i % len(params.drift)]))
         for i, (r, n, t) in enumerate(zip(rows, sizes, targets))],
        T.StructType([T.StructField("_mix_source", T.StringType()), T.StructField("source_size", T.LongType()),
                      T.StructField("target", T.DoubleType()), T.StructField("_mix_words", T.LongType()),
                      T.StructField("_mix_drift", T.DoubleType())]))
    before = Window.partitionBy("_mix_source").orderBy("_mix_bucket")
    bases = (buckets.withColumn("_mix_base", F.sum("_mix_sum").over(before) - F.col("_mix_sum"))
             .select(F.col("_mix_source").alias("_mix_s"), F.col("_mix_bucket").alias("_mix_b"), "_mix_base"))
    inside = (Window.partitionBy(source_col, "_mix_bucket")
              .orderBy("_mix_key", "_mix_size", F.xxhash64(F.col(text_col)))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = sized.withColumn("_mix_run", F.sum("_mix_size").over(inside))
    joined = (ranked.join(bases, F.col(source_col).eqNullSafe(F.col("_mix_s"))
                          & (F.col("_mix_bucket") == F.col("_mix_b")))
              .join(F.broadcast(plan), F.col(source_col).eqNullSafe(F.col("_mix_source"))))  # <= max_sources rows
    size, total = F.col("_mix_size"), F.col("_mix_words")
    off = F.col("_mix_base") + F.col("_mix_run") - size
    full = F.when(F.col("source_size") > 0, idiv(total, F.greatest(F.col("source_size"), F.lit(1)))).otherwise(F.lit(0))
    extra = F.greatest(F.lit(0), F.least(size, total - F.col("_mix_full") * F.col("source_size") - F.col("_mix_off")))
    epochs = F.when(size == 0, F.lit(0)).otherwise(
        F.col("_mix_full") + F.when(F.col("_mix_extra") > 0, 1).otherwise(0)).cast("bigint")
    some = F.col("taken") > 0
    out = (joined.withColumn("_mix_off", off).withColumn("_mix_full", full)
           .withColumn("_mix_extra", extra)
           .withColumn("size", size)
           .withColumn("taken", F.col("_mix_full") * size + F.col("_mix_extra"))
           .withColumn("epochs", epochs)
           .withColumn("first_position", F.when(some, position(F.col("_mix_off"), total, F.col("_mix_drift"))))
           .withColumn("last_position", F.when(some, position(
               F.col("_mix_off") + (F.col("epochs") - 1) * F.col("source_size"), total, F.col("_mix_drift")))))
    return out.select(*base.columns, *OUT)


def training_order(mixed: DataFrame) -> DataFrame:
    """``mixed`` range-partitioned and sorted by the position at which a document first appears.

    Documents that the mix does not take come last.
    """
    due = F.coalesce(F.col("first_position"), F.lit(2.0))
    # the number of ranges follows spark.sql.shuffle.partitions
    # and documents that share a position are spread by a hash
    return mixed.repartitionByRange(due, F.xxhash64(*mixed.columns)).sortWithinPartitions(due)
