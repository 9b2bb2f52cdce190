"""T1 under a given rank table, as a dictionary-encoded join.

A text is split into pre-tokens on the JVM; each *distinct* piece is counted (partial sums in the map tasks) and encoded
once, so the cost of the merges follows the vocabulary of pieces and not the corpus.  Ids come back to the documents in
ways which together cover every piece:

* The most frequent pieces, at most ``HOT_PIECES``, are a broadcast dictionary.  A narrow Arrow pass looks up all pieces of
  a batch at once; what it does not know leaves a hole in the document's ids.
* With the rank table at hand (``table``), a piece that the dictionary does not know is encoded where it stands, each
  distinct one of a slice once: one narrow pass, and the dictionary needs the frequent pieces only.
* Without it, pieces in holes are joined with the written dictionary by a shuffle on the piece.  A piece that is not among the frequent
  ones has at most ``1 / HOT_PIECES`` of all occurrences, so this join has no hot key, whatever the corpus.  Their ids
  return by document and position, and one more pass fills the holes.

Documents are told apart by a row number given once and written, so null and repeated keys keep their rows.  A document
without text has the end-of-text id only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenweave.functions.common import ship_by_value
from tokenweave.operators.bpe import MEMO_PIECES, merge_parts, pretokens_of
from tokenweave.operators.packed import list_slices
from tokenweave.operators.tokens import TOKENS_SCHEMA, _with_eot
from tokenweave.sources.shards import written

ship_by_value(__name__)

HOT_PIECES = 250_000
ROWS_AT_ONCE = 1000
HOLE = -1
HELD = "row bigint, doc_id bigint, ids array<int>, holes array<string>"


class RankPairs:
    """The merges that a rank table implies: two tokens merge if their bytes together are a token, lowest rank first."""

    def __init__(self, table: list[bytes]):
        self.table, self.ids = table, {t: i for i, t in enumerate(table)}

    def get(self, pair: tuple[int, int]) -> tuple[int, int] | None:
        r = self.ids.get(self.table[pair[0]] + self.table[pair[1]])
        return None if r is None else (r, r)

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token."""
        own = self.ids.get(piece)
        return [own] if own is not None else merge_parts([self.ids[piece[i:i + 1]] for i in range(len(piece))], self)


def _encode_kernel(table_bc):
    def run(batches):
        import pyarrow as pa

        pairs = RankPairs(table_bc.value)
        for rb in batches:
            ids = [pairs.encode(p.encode("utf-8")) for p in rb.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(ids, pa.list_(pa.int32()))], names=["piece", "cnt", "ids"])
    return run


def piece_dictionary(docs: DataFrame, table: list[bytes], limit: int | None = None) -> DataFrame:
    """``(piece, cnt, ids)``: the distinct pieces of ``docs``, their counts and ids, written once.

    ``limit``: only frequent ones, at most as many; the others are for ``encode_pieces`` with the table.
    """
    if [b for b in range(256) if bytes([b]) not in set(table)]:
        raise ValueError("a rank table needs every single byte")
    counts = docs.select(F.explode(pretokens_of(F.col("text"))).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("cnt"))
    if limit is not None:
        counts = written(counts, "piece-counts")
        counts = counts.where(F.col("cnt") >= frequent_pieces(counts, limit))
    bc = docs.sparkSession.sparkContext.broadcast(table)
    return written(counts.mapInArrow(_encode_kernel(bc), "piece string, cnt bigint, ids array<int>"), "pieces")


def frequent_pieces(dictionary: DataFrame, limit: int) -> int:
    """The smallest power of two for which at most ``limit`` pieces occur as often.

    A histogram of at most 64 rows decides; no pieces are sorted.
    """
    level = F.floor(F.log2(F.col("cnt").cast("double"))).cast("int").alias("level")
    total, least = 0, 62
    for r in sorted(dictionary.groupBy(level).count().collect(), key=lambda r: -r["level"]):
        total += r["count"]
        if total > limit:
            break
        least = r["level"]
    return 1 << least


def _arrays(hot: DataFrame, limit: int):
    """A bounded dictionary as arrays: pieces, lengths of their ids, and the ids."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    table = hot.select("piece", "ids").toArrow().combine_chunks()
    if table.num_rows > limit:
        raise ValueError(f"frequent pieces: more than {limit} rows; refusing to collect")
    pieces, ids = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table["piece"], table["ids"]))
    if not table.num_rows:
        return pa.array([], pa.string()), np.empty(0, np.uint16), np.empty(0, np.uint16)
    lens = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
    return pieces.cast(pa.string()), lens.astype(np.uint16), ids.flatten().to_numpy(zero_copy_only=False).astype(np.uint16)


def _encode_unknown(unknown, pairs: RankPairs, memo: dict):
    """Pieces that the dictionary does not know: for each its number among the distinct ones; their lengths and ids."""
    import numpy as np
    import pyarrow.compute as pc

    coded = pc.dictionary_encode(unknown)
    ids = [np.empty(0, np.int32)]
    for piece in coded.dictionary.to_pylist():
        e = memo.get(piece)
        if e is None:
            if len(memo) >= MEMO_PIECES:
                memo.clear()
            e = memo[piece] = np.array(pairs.encode(piece.encode("utf-8")), np.int32)
        ids.append(e)
    return coded.indices.to_numpy(zero_copy_only=False), np.array([len(e) for e in ids[1:]], np.int64), np.concatenate(ids)


def _table_kernel(hot_bc, table_bc, eot: int | None):
    """Every piece in one pass: looked up, or encoded where it is not known."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        known, hot_lens, hot_ids = hot_bc.value
        hot_lens = hot_lens.astype(np.int64)
        starts, own = np.cumsum(hot_lens) - hot_lens, hot_ids.astype(np.int32)
        pairs, memo = RankPairs(table_bc.value), {}
        for rb in list_slices(batches, 1):
            lists = rb.column(1)
            flat = lists.flatten()
            at = pc.fill_null(pc.index_in(flat, value_set=known), len(known)).to_numpy(zero_copy_only=False).astype(np.int64)
            # ids of a slice's unknown pieces stand behind those of the known ones
            rare = at == len(known)
            number, added, more = _encode_unknown(flat.filter(pa.array(rare)), pairs, memo)
            at[rare] += number
            first = np.concatenate([starts, len(own) + np.cumsum(added) - added])
            width = np.concatenate([hot_lens, added])[at]
            ends = np.cumsum(width)
            spot = np.arange(int(width.sum()), dtype=np.int64) + np.repeat(first[at] - (ends - width), width)
            values = np.concatenate([own, more])[spot]
            bounds = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = bounds - bounds[0]
            before = np.concatenate([[0], ends])
            out, n = _with_eot(before[bounds[1:]] - before[bounds[:-1]], values, eot)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(n), out], names=["doc_id", "n", "ids"])
    return run


def _lookup_kernel(hot_bc, eot: int | None):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        known, lens, flat_ids = hot_bc.value
        # the last entry stands for a piece that is not known
        lens, flat_ids = np.append(lens, 1).astype(np.int64), np.append(flat_ids, HOLE).astype(np.int32)
        starts = np.cumsum(lens) - lens
        for rb in (rb.slice(i, ROWS_AT_ONCE) for rb in batches for i in range(0, rb.num_rows, ROWS_AT_ONCE)):
            lists = rb.column(2)
            flat = lists.flatten()
            at = pc.fill_null(pc.index_in(flat, value_set=known), len(known)).to_numpy(zero_copy_only=False).astype(np.int64)
            width = lens[at]
            ends = np.cumsum(width)
            values = flat_ids[np.arange(int(width.sum()), dtype=np.int64) + np.repeat(starts[at] - (ends - width), width)]
            bounds = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = bounds - bounds[0]
            before = np.concatenate([[0], ends])
            out, _ = _with_eot(before[bounds[1:]] - before[bounds[:-1]], values, eot)
            rare = at == len(known)
            missed = np.concatenate([[0], np.cumsum(rare)])[bounds].astype(np.int32)
            holes = pa.ListArray.from_arrays(pa.array(missed), flat.filter(pa.array(rare)))
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), out, holes], names=["row", "doc_id", "ids", "holes"])
    return run


def _fill_kernel(batches):
    import numpy as np
    import pyarrow as pa

    for rb in batches:
        ids, fills = rb.column(1), rb.column(2)
        flat, parts = ids.flatten().to_numpy(zero_copy_only=False), fills.flatten()
        hole = flat == HOLE
        width = np.ones(len(flat), np.int64)
        width[hole] = np.diff(parts.offsets.to_numpy(zero_copy_only=False))
        own = np.repeat(~hole, width)
        out = np.empty(len(own), np.int32)
        out[own] = flat[~hole]
        out[~own] = parts.flatten().to_numpy(zero_copy_only=False)
        bounds = ids.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(width)])[bounds - bounds[0]]
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out))
        yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(np.diff(ends)), lists], names=["doc_id", "n", "ids"])


def encode_pieces(docs: DataFrame, dictionary: DataFrame, eot: int | None, hot_pieces: int = HOT_PIECES,
                  table: list[bytes] | None = None) -> DataFrame:
    """``(doc_id, n, ids)`` of ``docs`` (``doc_id``, ``text``), whose pieces are all in ``dictionary`` or under ``table``.

    ``eot`` is put first (None: not, as for prompts).
    """
    spark = docs.sparkSession
    least = frequent_pieces(dictionary, hot_pieces)
    bc = spark.sparkContext.broadcast(_arrays(dictionary.where(F.col("cnt") >= least).limit(hot_pieces + 1), hot_pieces))
    if table is not None:
        kernel = _table_kernel(bc, spark.sparkContext.broadcast(table), eot)
        return docs.select("doc_id", pretokens_of(F.col("text")).alias("pieces")).mapInArrow(kernel, TOKENS_SCHEMA)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", pretokens_of(F.col("text")).alias("pieces"))
    held = written(rows.mapInArrow(_lookup_kernel(bc, eot), HELD), "encoded")
    whole = held.where(F.size("holes") == 0).select("doc_id", F.size("ids").cast("bigint").alias("n"), "ids")
    open_ = held.where(F.size("holes") > 0)
    found = (open_.select("row", F.posexplode("holes").alias("at", "piece"))
             .join(dictionary.where(F.col("cnt") < least).select("piece", F.col("ids").alias("part")), "piece")
             .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts")))
    filled = (open_.select("row", "doc_id", "ids").join(found, "row")
              .select("doc_id", "ids", F.transform("parts", lambda p: p["part"]).alias("fills")))
    return whole.unionByName(filled.mapInArrow(_fill_kernel, TOKENS_SCHEMA))
