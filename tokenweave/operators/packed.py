"""16-bit packed tokens, as the reference stores them.

``data`` is a binary column of little-endian 16-bit ids: two bytes a token in shuffles and files.  Cutting and joining
pieces are binary substrings and ordered ``listagg`` on the JVM; whatever reads single ids does so with numpy over a whole
Arrow batch.  An id that does not fit stops the job when it is packed (F2), so packed tokens are in range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenweave.functions.common import ship_by_value

ship_by_value(__name__)


# ---------------------------------------------------------------- columns

def take(data: Column, start: Column | int, count: Column | int) -> Column:
    """``count`` ids from place ``start`` on."""
    start, count = (F.lit(v) if isinstance(v, int) else v for v in (start, count))
    return F.substring(data, (start * 2 + 1).cast("int"), (count * 2).cast("int"))


def id_at(data: Column, place: Column | int) -> Column:
    """The id at one place."""
    one = take(data, place, 1)
    return F.conv(F.hex(F.concat(F.substring(one, 2, 1), F.substring(one, 1, 1))), 16, 10).cast("int")


def joined(piece: str, order: str) -> Column:
    """Aggregate: the pieces of a group, one after the other in ``order``."""
    return F.expr(f"listagg({piece}) WITHIN GROUP (ORDER BY {order})")


# ---------------------------------------------------------------- Arrow batches

def packed_array(lists):
    """A list array of ids as a binary array of 16-bit ids."""
    import numpy as np
    import pyarrow as pa

    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and (flat.min() < 0 or flat.max() > 0xFFFF):
        raise ValueError("an id does not fit the 16 bits of a shard token")
    ends = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = (ends - ends[0]) * 2
    if ends[-1] >= 1 << 31:
        raise ValueError("a batch holds 2**30 ids or more; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32).tobytes()),
                                                           pa.py_buffer(np.ascontiguousarray(flat, dtype="<u2").tobytes())])


def flat_ids(data):
    """``(ids, starts, lengths)`` of a binary array, without a loop over rows."""
    import numpy as np

    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64)
    buf = data.buffers()[2]
    ids = np.frombuffer(buf, "<u2", (ends[-1] - ends[0]) // 2, ends[0]) if buf is not None and ends[-1] > ends[0] else np.empty(0, "<u2")
    return ids.astype(np.int64), (ends[:-1] - ends[0]) // 2, np.diff(ends) // 2


TOKENS_AT_ONCE = 1 << 20


def slices(batches, size_col: int, per_token: int = 2):
    """Arrow batches in slices of about ``TOKENS_AT_ONCE`` tokens (a longer row alone): views, nothing is copied.

    The ids of a slice are widened for numpy, so this bounds a task's memory whatever the length of the rows.
    """
    import numpy as np

    for rb in batches:
        data = rb.column(size_col)
        if not len(data):
            yield rb
            continue
        ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64)
        part = (ends[1:] - ends[0]) // (per_token * TOKENS_AT_ONCE)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(data)]
        for a, b in zip(cuts, cuts[1:]):
            yield rb.slice(a, b - a)


ITEMS_AT_ONCE = 1 << 17


def list_slices(batches, list_col: int):
    """Arrow batches in slices of about ``ITEMS_AT_ONCE`` list items (a longer row alone): views, as ``slices``.

    Kernels hold several wide numbers for each item, so this bounds a task's memory whatever the batches hold.
    """
    import numpy as np

    for rb in batches:
        if not rb.num_rows:
            yield rb
            continue
        ends = rb.column(list_col).offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        part = (ends[1:] - ends[0]) // ITEMS_AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), rb.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield rb.slice(a, b - a)


def pack_text(df: DataFrame, eot: int, text: str = "text", data: str = "data") -> DataFrame:
    """Column ``text`` replaced by its UTF-8 bytes as packed ids, ``eot`` first (a null text has only that)."""
    schema = T.StructType([T.StructField(data, T.BinaryType()) if f.name == text else f for f in df.schema])
    at = df.columns.index(text)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for rb in slices(batches, at, 1):
            column = rb.column(at).cast(pa.binary())
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
            out = np.empty(int(ends[-1] - ends[0]) + len(column), "<u2")
            starts = ends - ends[0] + np.arange(len(ends))
            body = np.ones(len(out), bool)
            body[starts[:-1]] = False
            out[starts[:-1]] = eot
            if ends[-1] > ends[0]:
                out[body] = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]
            packed = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer((starts * 2).astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())])
            yield rb.set_column(at, data, packed)
    return df.mapInArrow(run, schema)


def pack(df: DataFrame, ids: str = "ids", data: str = "data") -> DataFrame:
    """Column ``ids`` (array) replaced by ``data`` (packed)."""
    schema = T.StructType([T.StructField(data, T.BinaryType()) if f.name == ids else f for f in df.schema])
    at = df.columns.index(ids)

    def run(batches):
        for rb in list_slices(batches, at):
            yield rb.set_column(at, data, packed_array(rb.column(at)))
    return df.mapInArrow(run, schema)


def unpack(df: DataFrame, data: str = "data", ids: str = "ids") -> DataFrame:
    """Column ``data`` (packed) replaced by ``ids`` (array of int)."""
    schema = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType(), False)) if f.name == data else f for f in df.schema])
    at = df.columns.index(data)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for rb in slices(batches, at):
            flat, _, n = flat_ids(rb.column(at))
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield rb.set_column(at, ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))))
    return df.mapInArrow(run, schema)


def digests(df: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Packed columns summarised: ``wanted`` maps an output to (packed column, kind); other columns stay.

    Kinds: ``sum``; ``wsum``, each id times its place modulo 1009 plus one; ``at``, each id times its place in the
    shard (``pos`` + place) modulo 1009.
    """
    arrays = {a for a, _ in wanted.values()}
    kept = [f for f in df.schema if f.name not in arrays]
    schema = T.StructType(kept + [T.StructField(o, T.LongType()) for o in wanted])
    names = [f.name for f in kept]
    first = df.columns.index(next(iter(wanted.values()))[0])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for rb in slices(batches, first):
            parts = {a: flat_ids(rb.column(rb.schema.get_field_index(a))) for a in arrays}
            out = []
            for a, kind in wanted.values():
                ids, starts, n = parts[a]
                if kind != "sum":
                    place = np.arange(len(ids), dtype=np.int64) - np.repeat(starts, n)
                    if kind == "at":
                        pos = rb.column(rb.schema.get_field_index("pos")).to_numpy(zero_copy_only=False)
                        ids = ids * ((place + np.repeat(pos, n)) % 1009)
                    else:
                        ids = ids * (place % 1009 + 1)
                total = np.concatenate([[0], np.cumsum(ids)])
                out.append(pa.array(total[starts + n] - total[starts], pa.int64()))
            yield pa.RecordBatch.from_arrays([*(rb.column(rb.schema.get_field_index(c)) for c in names), *out], names=[*names, *wanted])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, table: list[bytes], data: str = "data") -> DataFrame:
    """T5: packed ids replaced by the bytes that ``table`` gives them; an id past the table (end-of-text) has none."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == data else f for f in df.schema])
    at, bc = df.columns.index(data), df.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        size = np.zeros(1 << 16, np.int64)
        size[:len(bc.value)] = [len(t) for t in bc.value]
        first = np.cumsum(size) - size
        letters = np.frombuffer(b"".join(bc.value), np.uint8)
        for rb in slices(batches, at):
            ids, starts, n = flat_ids(rb.column(at))
            width = size[ids]
            ends = np.cumsum(width)
            out = letters[np.arange(int(width.sum()), dtype=np.int64) + np.repeat(first[ids] - (ends - width), width)]
            total = np.concatenate([[0], ends])[np.concatenate([starts, starts[-1:] + n[-1:]])].astype(np.int32)
            text = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(total.tobytes()), pa.py_buffer(out.tobytes())])
            yield rb.set_column(at, data, text)
    return df.mapInArrow(run, schema)
