"""Benchmark decontamination by SimHash over item-sized windows.

Texts become words: A-Z lower-cased, ASCII punctuation and white space separate.  A document's windows of an
item's number of words (the whole document if it is shorter) get a 64-bit SimHash of their words, as the items
do.  A multi-index of ``BLOCKS`` byte blocks, each probed with at most ``FLIPS`` changed bits, finds every item
fingerprint within ``RADIUS`` bits: by the pigeonhole principle two fingerprints within the radius differ in at
most ``FLIPS`` bits of some block.  Candidates are verified exactly: the shingles of ``shingle`` words of window
and item, weighted by how often they occur, must have a Jaccard similarity of ``threshold`` or more.

Windows that share no shingle with any item have similarity 0 and are not fingerprinted; that leaves out most of
a corpus and no match.  Nothing is shuffled; texts are read by a narrow pass a block.  The benchmark is a stated query
set: it is read in blocks of at most ``block_items`` items and ``block_bytes`` bytes, each against all rows; what one
block found is written before the next is read, so the driver and a task hold one block.

Defined cases: null and wordless texts or items match nothing; items of fewer words than a shingle are one
shingle; each (document, item) pair gives one match, its best window, the first of equals; repeated documents
and items are matched each; an empty table on either side gives no match; an input column named like the output
column is replaced.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenweave.functions.common import ship_by_value
from tokenweave.llm.common import as_bytes, drop_columns_ignoring_case, materialise

ship_by_value(__name__)

RADIUS, BLOCKS, FLIPS = 15, 8, 1  # BLOCKS * (FLIPS + 1) > RADIUS
STRETCH, STRETCH_PAIRS = 65_536, 1 << 24  # words, and pairs of windows and items, looked at at once
MATCH = "array<struct<item_id:bigint,first_word:bigint,n_words:bigint,distance:int,similarity:double>>"
_SPLIT = bytes.maketrans(bytes(range(65, 91)) + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", bytes(range(97, 123)) + b" " * 32)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_SPLIT).split()


def shingles(words: list[bytes], k: int) -> Counter:
    return Counter(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)) if words)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def window_simhashes(words: list[bytes], starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` words from each start."""
    hashes = np.frombuffer(b"".join([xxhash.xxh64_digest(w) for w in words]), np.uint8).reshape(-1, 8)
    votes = np.zeros((len(words) + 1, 64), np.int32)
    np.cumsum(np.unpackbits(hashes, axis=1).astype(np.int8) * 2 - 1, axis=0, out=votes[1:])
    over = votes[starts + size] - votes[starts] > 0
    return np.packbits(over, axis=1).view(">u8").astype(np.uint64).ravel()


class Index:
    """A block of benchmark items: shingle anchors and, by item size, the Hamming multi-index."""

    def __init__(self, items: list[tuple[int, bytes]], shingle: int) -> None:
        self.shingle = shingle
        self.ids, self.words = [], []
        for key, text in items:
            if own := words_of(text):
                self.ids.append(key)
                self.words.append(own)
        self.vocab = {w: i for i, w in enumerate(dict.fromkeys(w for ws in self.words for w in ws), 1)}
        rng = np.random.default_rng(7)
        self.mix = (rng.integers(1, 1 << 62, shingle, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.counts = [shingles(ws, shingle) for ws in self.words]
        owners: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))  # shingle length, hash: items
        self.by_size: dict[int, list[int]] = defaultdict(list)
        for i, ws in enumerate(self.words):
            self.by_size[len(ws)].append(i)
            k = min(shingle, len(ws))
            ids = np.fromiter((self.vocab[w] for w in ws), np.uint64, len(ws))
            for h in np.unique(self._hash(ids, np.arange(len(ws) - k + 1), k)).tolist():
                owners[k][h].append(i)
        self.owners = {k: dict(v) for k, v in owners.items()}
        self.known = {k: np.array(sorted(v), np.uint64) for k, v in owners.items()}
        self.tables = {}
        for size, members in self.by_size.items():
            codes = np.concatenate([window_simhashes(self.words[i], np.zeros(1, np.int64), size) for i in members])
            table = np.zeros((BLOCKS, 256, len(members)), bool)
            own = codes[:, None].view(np.uint8).reshape(-1, BLOCKS)
            for b in range(BLOCKS):
                for flip in (0, *(1 << x for x in range(8))):  # at most FLIPS bits
                    table[b, own[:, b] ^ flip, np.arange(len(members))] = True
            self.tables[size] = (np.array(members), codes, table)

    def _hash(self, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for j in range(k):
            out += ids[at + j] * self.mix[j]
        return out ^ (out >> np.uint64(29))

    def anchors(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Places of shingles that an item has: (place, item, shingle length)."""
        inside = ids > 0
        for k, known in self.known.items():
            if len(ids) < k:
                continue
            ok = inside[:len(ids) - k + 1].copy()
            for j in range(1, k):
                ok &= inside[j:len(ids) - k + 1 + j]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            h = self._hash(ids, at, k)
            found = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
            for p, x in zip(at[found].tolist(), h[found].tolist()):
                for i in self.owners[k][x]:
                    yield p, i, k


def near_pairs(words: list[bytes], at: np.ndarray, size: int, table: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of window starts and items within the radius, and their distances; a bounded stretch of words at a time."""
    members, codes, probes = table
    step = max(1, min(STRETCH, STRETCH_PAIRS // len(members)))
    out = []
    for group in np.split(at, np.searchsorted(at, np.arange(at[0] + step, at[-1] + 1, step))):
        if not len(group):
            continue
        lo = int(group[0])
        own = window_simhashes(words[lo:int(group[-1]) + size], group - lo, size)
        blocks = own[:, None].view(np.uint8).reshape(-1, BLOCKS)
        hit = np.zeros((len(group), len(members)), bool)
        for b in range(BLOCKS):
            hit |= probes[b, blocks[:, b]]
        w, m = np.nonzero(hit)
        far = np.bitwise_count(own[w] ^ codes[m])
        inside = far <= RADIUS
        out.append((group[w[inside]], m[inside], far[inside]))
    return tuple(np.concatenate(x) for x in zip(*out))


def matches_of(index: Index, text: bytes, threshold: float) -> list[dict]:
    """Items found in the text, one entry for each with its best window."""
    words = words_of(text)
    if not words:
        return []
    get = index.vocab.get
    ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
    near: dict[int, set[int]] = defaultdict(set)  # item size: window starts that hold a shingle of such an item
    n = len(words)
    for p, i, k in index.anchors(ids):
        size = len(index.words[i])
        wide = min(size, n)
        near[size].update(range(max(0, p - wide + k), min(p, n - wide) + 1))
    out = []
    for size, starts in near.items():
        wide = min(size, n)
        w, m, far = near_pairs(words, np.array(sorted(starts)), wide, index.tables[size])
        members = index.tables[size][0]
        best: dict[int, tuple] = {}
        for x in np.lexsort((w, far, m)).tolist():
            item, start = int(members[m[x]]), int(w[x])
            if item in best and best[item][0] == 1.0:
                continue
            like = similarity(shingles(words[start:start + wide], index.shingle), index.counts[item])
            if like >= threshold and like > best.get(item, (0.0,))[0]:
                best[item] = (like, start, int(far[x]))
        out += [{"item_id": index.ids[i], "first_word": s, "n_words": wide, "distance": d, "similarity": like}
                for i, (like, s, d) in best.items()]
    return sorted(out, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["first_word"]))


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_items: int,
                block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark in bounded blocks, one partition at a time on the driver."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("bigint"), F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    for key, text in rows.toLocalIterator():
        if block and (len(block) == block_items or size + len(text) > block_bytes):
            yield block
            block, size = [], 0
        block.append((key, bytes(text)))
        size += len(text)
    if block:
        yield block


def _finder(items: list[tuple[int, bytes]], shingle: int, threshold: float):
    fields = pa.list_(pa.struct([("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                                 ("distance", pa.int32()), ("similarity", pa.float64())]))

    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(items, shingle)
        for column in texts:
            yield pa.array([matches_of(index, t, threshold) for t in as_bytes(column)], fields)

    find.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(find, MATCH)


def find_leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", block_items: int = 4096,
               block_bytes: int = 32 << 20, out_col: str = "leaks") -> DataFrame:
    """``docs`` with ``out_col``: the benchmark items each text contains, and where (words)."""
    base = drop_columns_ignoring_case(docs, [out_col])
    found = None
    for block in item_blocks(benchmark, item_col, item_text_col, block_items, block_bytes):
        leaks = _finder(block, shingle, threshold)(F.col(text_col))
        if found is None:
            found = base.withColumn(out_col, leaks)
        else:  # written in between, so that the driver and a task hold one block
            found = materialise(found, "leaks").withColumn(out_col, F.concat(out_col, leaks))
    return base.withColumn(out_col, F.array().cast(MATCH)) if found is None else found
