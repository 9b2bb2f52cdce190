"""T1/T5/T6 in BPE mode: byte-pair merges learned on Spark, encode, decode.

Learning is in ``merges.py``, encoding under a given rank table in ``dictionary.py``.

Encoding is one narrow pass: Spark splits text into pre-tokens on the JVM;
an Arrow helper encodes each *unique* pre-token of a batch once (lowest rank
first, as byte-level BPE does) with the merge table broadcast (bounded by
the number of merges) and maps the results back to every occurrence with
vectorised numpy gathers.  Decoding indexes a literal array of token bytes.

Ids: bytes are 0..255, merge ``r`` makes id ``256 + r``, end-of-text is
``256 + merges``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenweave.functions.common import bounded_collect, ship_by_value
from tokenweave.operators.tokens import TOKENS_SCHEMA, _with_eot

ship_by_value(__name__)

# Fixed value: the byte-level pre-token pattern (contractions, letters,
# numbers, other symbols, whitespace), written for Java regex; (?U) makes \s
# Unicode-aware.
PRETOKEN_PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MERGES_SCHEMA = "rank int, left int, right int, token_id int, cnt bigint"


def pretokens_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), 0)


def symbols_of(piece: Column) -> Column:
    """The UTF-8 bytes of a piece as symbols of 16 bits, low byte first: ``7400 6800`` for ``th``."""
    return F.unhex(F.regexp_replace(F.hex(F.encode(piece, "UTF-8")), "(?<byte>..)", "${byte}00"))


def pretoken_counts(docs: DataFrame) -> DataFrame:
    """Distinct pre-tokens of two or more bytes, as symbols, with their corpus counts."""
    counts = (docs.select(F.explode(pretokens_of(F.col("text"))).alias("pretoken"))
              .groupBy("pretoken").agg(F.count(F.lit(1)).cast("bigint").alias("cnt")))
    return counts.where(F.octet_length("pretoken") > 1).select(symbols_of(F.col("pretoken")).alias("sym"), "cnt")


def merge_table(merges: DataFrame, bound: int) -> list[tuple[int, int, int]]:
    """The learned merges as (left, right, token_id) in rank order (bounded by ``bound``)."""
    rows = bounded_collect(merges.select("rank", "left", "right", "token_id").orderBy("rank"),
                           bound, "merge table")
    return [(int(r["left"]), int(r["right"]), int(r["token_id"])) for r in rows]


def token_bytes(table: list[tuple[int, int, int]]) -> list[bytes]:
    """Bytes of every id: 256 single bytes, then each merge's concatenation."""
    out = [bytes([i]) for i in range(256)]
    for a, b, _ in table:
        out.append(out[a] + out[b])
    return out


def bpe_word(data: bytes, ranks: dict) -> list[int]:
    """Byte-level BPE of one pre-token."""
    return merge_parts(list(data), ranks)


def merge_parts(parts: list[int], ranks) -> list[int]:
    """Merge the lowest-rank adjacent pair until none is left; ``ranks.get(pair)`` is (rank, id) or None."""
    if len(parts) > LONG_PIECE:
        return _bpe_long(parts, ranks)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get((parts[i], parts[i + 1]))
            if r is not None and (best is None or r[0] < best[0]):
                best, at = r, i
        if best is None:
            break
        parts[at:at + 2] = [best[1]]
    return parts


LONG_PIECE = 64
MEMO_PIECES = 200_000


def _bpe_long(parts: list[int], ranks) -> list[int]:
    """The same merges for a long piece, best pair first from a heap: n log n steps."""
    import heapq

    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (r := ranks.get((parts[i], parts[j]))) is not None:
            heapq.heappush(heap, (r[0], i, parts[i], parts[j], r[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else n
        if j >= n or parts[i] != a or parts[j] != b:
            continue  # a part of the pair was merged meanwhile
        parts[i], parts[j] = new, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


def _bpe_kernel(table_bc, eot: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from tokenweave.operators.packed import list_slices

        ranks = {(a, b): (r, t) for r, (a, b, t) in enumerate(table_bc.value)}
        memo: dict = {}
        for rb in list_slices(batches, 1):
            lists = rb.column(1)
            flat = lists.flatten()
            uniq = pc.unique(flat)
            enc = []
            for u in uniq.to_pylist():
                e = memo.get(u)
                if e is None:
                    if len(memo) >= MEMO_PIECES:
                        memo.clear()
                    e = memo[u] = bpe_word(u.encode("utf-8"), ranks)
                enc.append(e)
            ulen = np.array([len(e) for e in enc], dtype=np.int64)
            uoff = np.zeros(len(enc) + 1, dtype=np.int64)
            np.cumsum(ulen, out=uoff[1:])
            uvals = (np.concatenate([np.asarray(e, dtype=np.int32) for e in enc])
                     if enc else np.empty(0, np.int32))
            idx = pc.index_in(flat, value_set=uniq).to_numpy(zero_copy_only=False).astype(np.int64)
            lens = ulen[idx]
            starts = uoff[idx]
            total = int(lens.sum())
            ends = np.cumsum(lens)
            gather = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)
            vals = uvals[gather]
            # tokens per document = sum of its pre-tokens' token counts
            loff = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            loff = loff - loff[0]
            csum = np.concatenate([[0], ends])
            doc_lens = csum[loff[1:]] - csum[loff[:-1]]
            arr, n = _with_eot(doc_lens, vals, eot)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(n), arr],
                                             names=["doc_id", "n", "ids"])
    return run


def encode_bpe(docs: DataFrame, merges: DataFrame, max_merges: int = 50_000) -> DataFrame:
    """T1/T3 BPE mode: ``(doc_id, n, ids)`` with end-of-text first."""
    spark = docs.sparkSession
    table = merge_table(merges, max_merges)
    bc = spark.sparkContext.broadcast(table)
    src = docs.select("doc_id", pretokens_of(F.col("text")).alias("pretokens"))
    return src.mapInArrow(_bpe_kernel(bc, 256 + len(table)), TOKENS_SCHEMA)


def decode_bpe(ids: Column, table: list[tuple[int, int, int]], drop_eot: bool = True) -> Column:
    """T5 BPE mode: ids -> text; each id indexes a literal array of hex token bytes."""
    hexes = [b.hex().upper() for b in token_bytes(table)]
    eot = 256 + len(table)
    vocab = F.split(F.lit(" ".join(hexes)), " ")
    arr = F.filter(ids, lambda x: x != eot) if drop_eot else ids
    hexed = F.array_join(F.transform(arr, lambda x: F.element_at(vocab, x + 1)), "")
    return F.decode(F.unhex(hexed), "UTF-8")


# ---------------------------------------------------------------- a given rank table

def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a rank file: lines of the token in base 64 and its rank.

    Read on the driver (the file is a parameter of the job, of bounded size)
    and shipped to the tasks as a broadcast variable.
    """
    import base64

    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in f if line.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"ranks of {path} must be dense from 0")
    return [t for _, t in pairs]
