"""Column helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Token ids are stored in 16 bits: 0 <= id < 2**16.
TOKEN_ID_LIMIT = 65536
# Words are maximal runs of characters other than space, tab, CR and LF.
WORD_PATTERN = r"[^ \t\r\n]+"

# 2**48: the first 12 hex digits of an md5 give 48 uniform bits.
_HASH_SCALE = 281474976710656.0


def idiv(a: Column | str, b: Column | int) -> Column:
    """Exact integer division (SQL ``div``), never through double."""
    a = F.col(a) if isinstance(a, str) else a
    b = b if isinstance(b, Column) else F.lit(int(b))
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))


def uniform_hash(*parts: Column) -> Column:
    """Repeatable uniform draw in (0, 1) from md5 of the '|'-joined parts.

    The same value is computed by DuckDB as
    ``(('0x'||substr(md5(s),1,12))::bigint + 0.5) / 2**48``.
    """
    s = F.concat_ws("|", *[p.cast("string") for p in parts])
    h = F.conv(F.substring(F.md5(s), 1, 12), 16, 10).cast("bigint")
    return (h.cast("double") + F.lit(0.5)) / F.lit(_HASH_SCALE)


def ship_by_value(module_name: str) -> None:
    """Pickle the Arrow helpers of a module by value.

    Executors then need no copy of this package on their path; the helper
    code travels with the task closure.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def bounded_collect(df: DataFrame, bound: int, what: str) -> list:
    """Collect a table whose size is bounded by a job parameter.

    Raises instead of pulling an unexpectedly large table to the driver.
    """
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what}: more than {bound} rows; refusing to collect")
    return rows


def shard_label(prefix: str, split: Column, shard_index: Column) -> Column:
    """S4 file label: ``{prefix}_{split}_{index:06d}``."""
    return F.format_string(f"{prefix}_%s_%06d", split, shard_index)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after checking the row count; a plain join beyond it.

    Meant for derived tables that are small by construction (one row per
    batch, per shard, per bucket); the check is one cheap count job.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
