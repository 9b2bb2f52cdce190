"""Running sums over an ordered table of any size, as a tree scan.

Rows are range-sorted by the order columns, so a key that many rows share (null keys above all) is split by the columns
behind it, and written once with their running sum inside their part: the leaves.  Part totals are summed in groups of
``FAN``, these in groups of ``FAN`` again, until one group is left; the sums of earlier groups come back down the same
way.  No level has a task with more than ``FAN`` rows besides the leaves themselves, and nothing bounds their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenweave.functions.common import broadcast_if_small, idiv, ship_by_value
from tokenweave.sources.shards import written

ship_by_value(__name__)

FAN = 1024
PARTS_BROADCAST = 1_000_000


def _running(names: list[str], n: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        for rb in batches:
            sizes = rb.column(n).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes) + total
            before = ends - sizes
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(np.full(len(sizes), part, np.int64)), pa.array(before)], names=[*names, "part", "before"])
    return run


def scan_parts(parts: DataFrame, fan: int = FAN) -> DataFrame:
    """``(part, base)``: for each ``(part, total)`` the sum of the totals before it, level by level."""
    count = parts.count()
    if count <= fan:
        upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one group: at most ``fan`` rows
        return parts.select("part", F.coalesce(F.sum("total").over(upto), F.lit(0)).cast("bigint").alias("base"))
    grouped = parts.withColumn("up", idiv(F.col("part"), fan))
    above = scan_parts(grouped.groupBy(F.col("up").alias("part")).agg(F.sum("total").cast("bigint").alias("total")), fan)
    upto = Window.partitionBy("up").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = grouped.select("part", "up", F.coalesce(F.sum("total").over(upto), F.lit(0)).cast("bigint").alias("own"))
    return inside.join(above.select(F.col("part").alias("up"), F.col("base").alias("above")), "up").select("part", (F.col("above") + F.col("own")).alias("base"))


def ordered_offsets(rows: DataFrame, order: list[Column | str], fan: int = FAN) -> DataFrame:
    """``rows`` in ``order`` with ``off``, the sum of ``n`` before each row; written once, in files of neighbouring rows."""
    names = rows.columns
    summed = T.StructType([*rows.schema.fields, T.StructField("part", T.LongType()), T.StructField("before", T.LongType())])
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    leaves = written(ranged.mapInArrow(_running(names, names.index("n")), summed), "ordered")
    parts = written(leaves.groupBy("part").agg(F.sum("n").cast("bigint").alias("total")), "parts")
    bases = broadcast_if_small(scan_parts(parts, fan), PARTS_BROADCAST)
    return leaves.join(bases, "part").select(*names, (F.col("base") + F.col("before")).alias("off"))
