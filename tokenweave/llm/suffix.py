"""Suffix-array deduplication by a common-prefix-aware distributed merge sort.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.  Sorting every suffix is not
needed to find such strings.  Each window of ``length`` bytes picks the suffix whose first ``seed`` bytes have the
smallest hash (leftmost of equals), so equal windows pick suffixes at the same offset, and about one suffix in a
hundred is picked.  Those whose seed occurs once cannot belong to a repeated string and are left out (duplicate
detection, as in prefix-doubling string sorts).  The others are sorted:

* every task sorts its suffixes and sends them, front-coded (length of the common prefix with the suffix before,
  then the rest), to the part of the key range they belong to;
* a part merges its runs with a loser tree that knows the common prefix of every loser with the last winner, so
  it compares only bytes that no comparison has seen.  The merged order comes with its LCP array.

Suffixes of one seed are neighbours there.  Two of them, equal on ``r`` bytes to the right and ``l`` to the left of the
seed's start, share the windows that start ``length - r`` to ``l`` bytes before it; a window is repeated if some other
suffix shares it.  A seed that occurs over ``group_rows`` times is too much for one task.  Its windows are divided by
their distance from the pick: those of one half of the distances have a longer string in common than the seed, and by
its hash the suffixes are grouped anew, with equal contexts made one in the task that meets them.  Halves are halved
until a group is small enough to be sorted and merged like any other (``_refined``).  Hashes only form groups; that
strings are equal is always found by comparing their bytes.

Defined cases: a null text counts as empty; a text shorter than ``length`` keeps all; rows that repeat an id and a text
lose every byte if the text has ``length`` bytes, and are sorted as one text, so k of them cost k times one; null ids
are kept; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenweave.functions.common import broadcast_if_small, ship_by_value
from tokenweave.llm.common import as_bytes, column, materialise

ship_by_value(__name__)

_B = 0x9E3779B97F4A7C15
_B_INV = pow(_B, -1, 1 << 64)
HELD_CLASSES = 100_000  # suffixes of frequent seeds that a task compares before it passes them on
RUN_ROWS_MOST = 200_000
HOT_SEEDS_BROADCAST = 500_000
_STEP = 1 << 19  # window starts handled at once; places fit in 20 bits
_powers: dict[int, np.ndarray] = {}


@dataclass(frozen=True)
class SuffixParams:
    """``run_rows``: suffixes a task sorts at once (more if there are many parts); ``pair_rows``: distinct contexts
    compared pair by pair; ``group_rows``: suffixes that are merged as one group, without a further division."""

    length: int = 200
    seed: int = 32
    group_rows: int = 10_000
    run_rows: int = 20_000
    pair_rows: int = 24

    @property
    def span(self) -> int:
        """Places a window's pick can have; offsets and picks fit in a byte."""
        return self.length - self.seed + 1


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 1 << 14), base, np.uint64)
        out[0] = 1
        _powers[base] = np.cumprod(out)
    return _powers[base][:n]


def picks(text: bytes, p: SuffixParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Picked suffixes: place, smallest and largest distance of their windows' starts before it, seed hash."""
    n = len(text)
    out = []
    for lo in range(0, n - p.length + 1, _STEP):
        part = np.frombuffer(text, np.uint8)[lo:lo + _STEP + p.length - 1]
        m = len(part)
        sums = np.zeros(m + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power(_B, m), out=sums[1:])
        h = (sums[p.seed:] - sums[:-p.seed]) * _power(_B_INV, m - p.seed + 1)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        # the hash's upper bits with the place below them: the smallest is the leftmost of equal hashes
        key = (h & ~np.uint64(0xFFFFF)) | np.arange(len(h), dtype=np.uint64)
        w = p.span
        blocks = np.full(-(-len(key) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
        blocks[:len(key)] = key
        blocks = blocks.reshape(-1, w)
        before = np.minimum.accumulate(blocks, axis=1).ravel()
        after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = m - p.length + 1
        low = np.minimum(after[:starts], before[w - 1:w - 1 + starts])
        at = (low & np.uint64(0xFFFFF)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        last = np.append(first[1:], starts) - 1
        a = at[first]
        out.append((a + lo, a - last, a - first, h[a].view(np.int64)))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def _picks(p: SuffixParams):
    """Rows of picked suffixes; ``at`` packs place, smallest and largest distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, salts = (column(b, c).to_numpy(zero_copy_only=False) for c in ("doc", "salt"))
            found = [picks(t, p) for t in as_bytes(column(b, "text"))]
            sizes = [len(x[0]) for x in found]
            if not sum(sizes):
                continue
            place, near, far, h = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, sizes)), pa.array(np.repeat(salts, sizes)),
                 pa.array(place << 16 | near << 8 | far), pa.array(h)], names=["doc", "salt", "at", "seed"])
    return run


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that are known to agree on the first ``known`` bytes."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


# A suffix: key (seed hash, then the bytes from the place on), bytes before the place in reverse, document, salt, at.
Suffix = tuple[bytes, bytes, int, int, int]


def suffix(text: bytes, seed: int, at: int, doc: int, salt: int, p: SuffixParams) -> Suffix:
    # only as far as the pick's own windows reach: equal windows are owned by picks at the same distance
    place, near, far = at >> 16, at >> 8 & 255, at & 255
    # picks have small hashes, so the key begins with a product that spreads them over the whole range
    return ((seed * _B & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big") + text[place:place - near + p.length],
            text[place - far:place][::-1], doc, salt, at)


def encode_run(run: list[Suffix]) -> bytes:
    """A sorted run, front-coded in its keys and in its left contexts."""
    keys, lefts, docs, salts, ats = zip(*run)
    shared = [0, *(common_prefix(a, b) for a, b in zip(keys, keys[1:]))]
    left = [0, *(common_prefix(a, b) for a, b in zip(lefts, lefts[1:]))]
    sizes = np.array([shared, list(map(len, keys)), left, list(map(len, lefts))], "<u2")
    ids = np.array([docs, salts, ats], "<i8")
    body = (len(run).to_bytes(4, "big") + sizes.tobytes() + ids.tobytes() + b"".join([k[s:] for k, s in zip(keys, shared)]) + b"".join([x[s:] for x, s in zip(lefts, left)]))
    return zstandard.compress(body, 1)


def decode_run(blob: bytes) -> Iterator[tuple[int, Suffix]]:
    """The run's suffixes in order, each with its common prefix with the one before."""
    body = zstandard.decompress(blob)
    n = int.from_bytes(body[:4], "big")
    sizes = np.frombuffer(body, "<u2", 4 * n, 4).reshape(4, n).astype(np.int64)
    docs, salts, ats = np.frombuffer(body, "<i8", 3 * n, 4 + 8 * n).reshape(3, n).tolist()
    at = 4 + 32 * n
    side = at + int((sizes[1] - sizes[0]).sum())
    key = left = b""
    for i, (shared, size, shared_left, size_left) in enumerate(sizes.T.tolist()):
        key = key[:shared] + body[at:at + size - shared]
        at += size - shared
        left = left[:shared_left] + body[side:side + size_left - shared_left]
        side += size_left - shared_left
        yield shared, (key, left, docs[i], salts[i], ats[i])


def merge_runs(runs: list[Iterator[tuple[int, Suffix]]]) -> Iterator[tuple[int, Suffix]]:
    """Merge sorted runs by a loser tree; yields suffixes in order with their common prefix with the one before.

    ``shared[i]`` is the common prefix of run i's head with the last winner.  Of two heads the one that shares more is
    smaller, without looking at a byte; if both share as much, comparison starts behind what they share.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[Suffix | None] = [None] * size
    shared = [0] * size
    for i, run in enumerate(runs):
        step = next(run, None)
        heads[i] = step and step[1]

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs' heads."""
        x, y = heads[a], heads[b]
        if y is None or x is None:
            return (a, b) if y is None else (b, a)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        k, m = x[0], y[0]
        c = common_prefix(k, m, shared[a])
        if c == len(k) or (c < len(m) and k[c] < m[c]):
            shared[b] = c
            return a, b
        shared[a] = c
        return b, a

    tree = [0] * size  # losers of the inner games
    level = list(range(size))
    while len(level) > 1:
        games = [play(a, b) for a, b in zip(level[::2], level[1::2])]
        half = len(games)
        for i, (_, loser) in enumerate(games):
            tree[half + i] = loser
        level = [winner for winner, _ in games]
    best = level[0]
    while heads[best] is not None:
        yield shared[best], heads[best]
        step = next(runs[best], None) if best < len(runs) else None
        heads[best] = step and step[1]
        shared[best] = step[0] if step else 0
        node = (best + size) // 2
        while node:
            best, tree[node] = play(best, tree[node])
            node //= 2


def shared_windows(group: list[tuple[int, Suffix]], p: SuffixParams) -> Iterator[tuple[int, int, int, int]]:
    """Removed ranges (document, salt, begin, end) of the suffixes of one seed, in merged order with their LCPs."""
    length = p.length
    members: dict[tuple[bytes, bytes], list[Suffix]] = defaultdict(list)
    right: list[int] = []  # common prefix of a distinct context's bytes with those of the distinct one before
    low = length
    for i, (lcp, s) in enumerate(group):
        low = min(low, lcp - 8) if i else length
        if s[:2] not in members:
            right.append(low)
            low = length
        members[s[:2]].append(s)
    contexts = list(members)
    m = len(contexts)
    whole = [len(members[c]) > 1 for c in contexts]
    ranges: list[list[tuple[int, int]]] = [[(0, length)] if w else [] for w in whole]  # distances of repeated windows
    if m > 1 and m <= p.pair_rows:
        for i in range(m):
            r = length
            for j in range(i + 1, m):
                r = min(r, right[j])
                near = length - r
                if near >= p.span:
                    break
                far = common_prefix(contexts[i][1], contexts[j][1])
                if far >= near:
                    ranges[i].append((near, far))
                    ranges[j].append((near, far))
    elif m > 1:
        # classes of contexts that share a window, for each distance at once: by the bytes to the right, which are
        # neighbours in the merged order, and by those to the left, neighbours in an order of their own
        order = sorted(range(m), key=lambda i: contexts[i][1])
        left = np.array([0, *(common_prefix(contexts[a][1], contexts[b][1]) for a, b in zip(order, order[1:]))])
        to_right, back = np.array(right), np.array(order)
        near, far = (f(s[4] >> b & 255 for c in contexts for s in members[c]) for f, b in ((min, 8), (max, 0)))
        for d in range(near, far + 1):
            code = np.cumsum(to_right < length - d) * (m + 1)
            code[back] += np.cumsum(left < d)
            _, where, n = np.unique(code, return_inverse=True, return_counts=True)
            for i in np.flatnonzero(n[where] > 1).tolist():
                if ranges[i] and ranges[i][-1][1] >= d - 1:
                    ranges[i][-1] = (ranges[i][-1][0], max(ranges[i][-1][1], d))
                else:
                    ranges[i].append((d, d))
    for c, found in zip(contexts, ranges):
        for _, _, doc, salt, at in members[c]:
            place, near, far = at >> 16, at >> 8 & 255, at & 255
            for a, z in found:
                a, z = max(a, near), min(z, far)
                if a <= z:
                    yield doc, salt, place - z, place - a + length


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Documents with their marked suffixes; rows of one document that follow each other are copies and given once."""
    last = None
    for b in batches:
        marks, texts = column(b, "marks"), column(b, "text")
        flat = marks.flatten()
        at, seed = (flat.field(c).to_numpy(zero_copy_only=False).tolist() for c in ("at", "seed"))
        ends = np.cumsum(marks.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        for i, (doc, salt, a, z) in enumerate(zip(column(b, "doc").to_pylist(), column(b, "salt").to_pylist(), [0, *ends], ends)):
            if (doc, salt) != last:
                last = doc, salt
                yield texts[i].as_buffer().to_pybytes(), doc, salt, zip(at[a:z], seed[a:z])


def _marked_suffixes(batches: Iterator[pa.RecordBatch], p: SuffixParams) -> Iterator[Suffix]:
    for text, doc, salt, marks in _marked(batches):
        for at, seed in marks:
            yield suffix(text, seed, at, doc, salt, p)


def _class_suffixes(batches: Iterator[pa.RecordBatch], p: SuffixParams) -> Iterator[Suffix]:
    """Suffixes of divided groups: the group's key stands for the seed."""
    for b in batches:
        for seed, doc, salt, at, context in zip(*(column(b, c).to_pylist() for c in ("key", "doc", "salt", "at", "context"))):
            far = at & 255
            yield (seed * _B & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "big") + context[far:], context[:far][::-1], doc, salt, at


def _runs(p: SuffixParams, parts: int, suffixes=_marked_suffixes):
    """Sorted runs of a task's suffixes, cut into the parts of the key range and front-coded."""
    rows = max(p.run_rows, min(8 * parts, RUN_ROWS_MOST))  # so that a part's share is worth coding

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Suffix] = []

        def send() -> pa.RecordBatch:
            held.sort(key=lambda s: s[0])
            cut: dict[int, list[Suffix]] = defaultdict(list)
            for s in held:
                cut[int.from_bytes(s[0][:4], "big") * parts >> 32].append(s)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(cut), pa.int32()), pa.array([encode_run(x) for x in cut.values()], pa.binary())],
                                              names=["part", "run"])

        for s in suffixes(batches, p):
            held.append(s)
            if len(held) >= rows:
                yield send()
        if held:
            yield send()
    return run


RANGE_SCHEMA = "doc bigint, salt bigint, begin bigint, end bigint"


def _range_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["doc", "salt", "begin", "end"])


def _merge(p: SuffixParams):
    """Merge the runs of each part; return the removed ranges of its suffixes."""
    def part_ranges(blobs: list[bytes]) -> Iterator[tuple]:
        group: list[tuple[int, Suffix]] = []
        for lcp, s in merge_runs([decode_run(x) for x in blobs]):
            if lcp < 8 + p.seed and group:  # another seed
                if len(group) > 1:
                    yield from shared_windows(group, p)
                group = []
            group.append((lcp, s))
        if len(group) > 1:
            yield from shared_windows(group, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blobs, rows = None, [], []
        for b in (*batches, None):
            pairs = zip(column(b, "part").to_pylist(), column(b, "run").to_pylist()) if b is not None else [(None, b"")]
            for at, blob in pairs:
                if at != part:
                    for row in part_ranges(blobs):
                        rows.append(row)
                        if len(rows) >= 100_000:
                            yield _range_batch(rows)
                            rows = []
                    part, blobs = at, []
                blobs.append(blob)
        if rows:
            yield _range_batch(rows)
    return run


# A class: the windows of a suffix whose distances from the pick are in a half (of a half ...) of all distances.
# ``at`` has the place and the smallest and largest distance, ``context`` the bytes that its windows cover.
# Rows without a key are removed ranges.
CLASS_SCHEMA = ("key bigint, doc bigint, salt bigint, at bigint, low int, high int, context binary, begin bigint, end bigint")
_CLASS_TYPES = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("salt", pa.int64()), ("at", pa.int64()), ("low", pa.int32()),
                          ("high", pa.int32()), ("context", pa.binary()), ("begin", pa.int64()), ("end", pa.int64())])

# document, salt, place, smallest and largest distance, smallest and largest of the half, context
Class = tuple[int, int, int, int, int, int, int, bytes]


def _whole_classes(batches: Iterator[pa.RecordBatch], p: SuffixParams) -> Iterator[Class]:
    for text, doc, salt, marks in _marked(batches):
        for at, _ in marks:
            place, near, far = at >> 16, at >> 8 & 255, at & 255
            yield doc, salt, place, near, far, 0, p.span - 1, text[place - far:place - near + p.length]


def _stored_classes(batches: Iterator[pa.RecordBatch], p: SuffixParams) -> Iterator[Class]:
    for b in batches:
        cols = (column(b, c).to_pylist() for c in ("doc", "salt", "at", "low", "high", "context"))
        for doc, salt, at, low, high, context in zip(*cols):
            yield doc, salt, at >> 16, at >> 8 & 255, at & 255, low, high, context


def _halves(p: SuffixParams, classes):
    """Each class in two halves, keyed by the hash of the string that all windows of a half contain.

    Halves with equal bytes are made one: all their windows are repeated, so their ranges are removed (those of a
    document that overlap as one), and one of them stands for all in the next comparison.
    """
    def known(held: dict) -> Iterator[pa.RecordBatch]:
        rows, ranges = [], defaultdict(list)
        for (low, high, near, far, context), members in held.items():
            doc, salt, place = members[0]
            text = context[far - low:far - high + p.length]
            key = xxhash.xxh3_64_intdigest(text, low << 8 | high) - (1 << 63)
            rows.append((key, doc, salt, place << 16 | near << 8 | far, low, high, context, None, None))
            if len(members) > 1:
                for doc, salt, place in members:
                    ranges[doc, salt].append((place - far, place - near + p.length))
        for (doc, salt), found in ranges.items():
            rows += [(None, doc, salt, None, None, None, None, a, z) for a, z in _joined(found)]
        for i in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 20_000]), _CLASS_TYPES.types)], schema=_CLASS_TYPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = defaultdict(list)
        n = 0
        for doc, salt, place, near, far, low, high, context in classes(batches, p):
            middle = (low + high) // 2
            for lo, hi in ((low, middle), (middle + 1, high)):
                a, z = max(near, lo), min(far, hi)
                if a <= z:
                    held[lo, hi, a, z, context[far - z:far - a + p.length]].append((doc, salt, place))
                    n += 1
            if n >= HELD_CLASSES:
                yield from known(held)
                held, n = defaultdict(list), 0
        if held:
            yield from known(held)
    return run


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges by place, those that touch as one."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], z)
        else:
            out.append((a, z))
    return out


def _merged(runs: DataFrame, p: SuffixParams) -> DataFrame:
    tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # small by bytes but long by work, so the tasks are counted, not sized
    return runs.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_merge(p), RANGE_SCHEMA)


def _refined(marked: DataFrame, p: SuffixParams, parts: int) -> DataFrame:
    """Removed ranges of suffixes whose seed is too frequent for one task.

    A suffix at the edge of a passage that all documents share has its own context in each of them, but in every round
    only the half that reaches from the passage over its edge stays in a large group: two rows a round, and the rounds
    end after the logarithm of the distances.  A half of one distance has as many rows as tasks that hold it, at most.
    """
    spans = ["doc", "salt", "begin", "end"]
    classes = materialise(marked.mapInArrow(_halves(p, _whole_classes), CLASS_SCHEMA), "suffix-classes")
    out = None
    while True:
        keyed = classes.where("key is not null")
        # at most a key for every group_rows rows
        large = keyed.where("low < high").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > p.group_rows).select("key")
        large = materialise(large, "suffix-large")
        some = bool(large.limit(1).collect())
        large = broadcast_if_small(large, HOT_SEEDS_BROADCAST)
        ready = keyed.join(large, "key", "left_anti") if some else keyed
        runs = ready.select("key", "doc", "salt", "at", "context").mapInArrow(_runs(p, parts, _class_suffixes), "part int, run binary")
        found = _merged(runs, p).unionByName(classes.where("key is null").select(*spans))
        out = found if out is None else out.unionByName(found)
        if not some:
            return out
        rest = keyed.join(large, "key", "left_semi")
        classes = materialise(rest.mapInArrow(_halves(p, _stored_classes), CLASS_SCHEMA), "suffix-classes")


def repeated_ranges(docs: DataFrame, p: SuffixParams) -> DataFrame:
    """Byte ranges that repeated strings cover (``doc``, ``salt``, ``begin``, ``end``); ranges may overlap and end
    behind the text.

    ``docs`` has ``id``, ``doc``, ``salt`` and ``text``.
    """
    spark = docs.sparkSession
    found = materialise(docs.drop("id").mapInArrow(_picks(p), "doc bigint, salt bigint, at bigint, seed bigint"), "suffix-picks")
    # written, so that the join deals both sides anew and can split a frequent seed
    counts = materialise(found.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1"), "suffix-seeds")
    # copies of a row (equal id and text) have the same marks: a set keeps one of each, in the map tasks already
    mark = F.struct("at", "seed", "n")
    marks = materialise(found.join(counts, "seed").groupBy("doc", "salt")
                        .agg(F.collect_set(mark).alias("marks"), F.count("*").alias("rows")), "suffix-marks")

    def with_text(wanted) -> DataFrame:
        own = marks.select("doc", "salt", F.filter("marks", wanted).alias("marks")).where(F.size("marks") > 0)
        # all columns, so that the exchange of the texts is one with that of the last join
        joined = docs.join(own, ["doc", "salt"]).select(*docs.columns, "marks")
        return joined.sortWithinPartitions("doc", "salt")  # as the join leaves them; copies are neighbours

    # parts of the key range: the keys begin with a hash, so equal ranges hold equal shares
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = with_text(lambda m: m["n"] <= p.group_rows).mapInArrow(_runs(p, parts), "part int, run binary")
    out = _merged(runs, p)
    whole = marks.where(F.col("rows") > F.size("marks"))  # a text that is there again is repeated as a whole
    out = out.unionByName(whole.select("doc", "salt", F.lit(0).cast("bigint").alias("begin"), F.lit(1 << 62).alias("end")))
    if counts.where(F.col("n") > p.group_rows).limit(1).collect():
        out = out.unionByName(_refined(with_text(lambda m: m["n"] > p.group_rows), p, parts))
    return out


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols: list[list] = [[] for _ in range(4)]
        kept_texts = []
        lists = column(b, "ranges")
        for i, text in enumerate(as_bytes(column(b, "text"))):
            merged = _joined([(r["begin"], min(r["end"], len(text))) for r in lists[i].as_py() or []])
            kept = b"".join([text[a:z] for a, z in zip([0, *(e for _, e in merged)], [*(s for s, _ in merged), len(text)])])
            for c, v in zip(cols, (len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest())):
                c.append(v)
            kept_texts.append(kept)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([column(b, "id"), *[pa.array(c, t) for c, t in zip(cols, types)], pa.array(kept_texts, pa.binary())],
                                         names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, p: SuffixParams = SuffixParams(), id_col: str = "doc_id", text_col: str = "text",
                   keep_bytes: bool = True) -> DataFrame:
    """Every document without its repeated strings.

    Columns: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and, with
    ``keep_bytes``, ``kept``: the remaining bytes (a removed run can begin inside a character, so they are binary).
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    own = F.col(id_col).cast("bigint")
    # the salt tells rows of one id apart; rows equal in both are copies and share their ranges
    rows = docs.select(own.alias("id"), F.coalesce(own, F.lit(0)).alias("doc"),
                       F.xxhash64(text, own.isNull()).alias("salt"), text.alias("text"))
    ranges = (repeated_ranges(rows, p).groupBy("doc", "salt")
              .agg(F.collect_list(F.struct("begin", "end")).alias("ranges")))
    out = (rows.join(ranges, ["doc", "salt"], "left").select("id", "text", "ranges")
           .mapInArrow(_keep, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"))
    return (out if keep_bytes else out.drop("kept")).withColumnRenamed("id", id_col)
