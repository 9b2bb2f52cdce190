"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are 64 bits: a bit is 1 if it is set in over half of the XXH64 hashes of the text's word shingles.
Distinct fingerprints are looked up in index parts.  A part is the group of fingerprints that share a masked
bit pattern, the part's root: with ``radius + 2`` blocks of bits, two fingerprints within the radius agree on at
least two blocks, so one part for each pair of blocks holds every pair.  A part over ``split_rows`` is divided
once more by pairs of blocks of its other bits; for radius 2 the parts then have 16 free bits, so no task ever
holds over 65,536 fingerprints of a part.  Inside a part fingerprints are sorted by Gray rank, so neighbours
share most bits; nodes over runs of ``FAN`` hold the bits all members share, and pairs of nodes are dropped
together as soon as the differences of their shared bits exceed the radius.  A part returns a spanning
forest of its links (at most one edge a fingerprint), and components follow by large-star / small-star rounds.

Defined cases: a null or wordless text has fingerprint zero and links like any other; fewer words than a
shingle make one shingle of all; null ids are kept and never name a component; repeated rows share a
fingerprint; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenweave.functions.common import ship_by_value
from tokenweave.llm.common import as_bytes, column, materialise, pieces

ship_by_value(__name__)

FAN = 8
SEED = 42  # fixed value


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of a text's lower-cased word shingles, repeats included."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six white-space bytes
    if not words:
        return 0
    norm = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return int.from_bytes(digest(norm, SEED), "big")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    data = b"".join([digest(norm[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())])
    bits = np.unpackbits(np.frombuffer(data, np.uint8).reshape(-1, 8), axis=1)
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)
    return int.from_bytes(np.packbits(over).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 2000):
            fps = np.array([fingerprint(t, shingle) for t in as_bytes(column(b, "text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([column(b, "id"), column(b, "text_hash"), pa.array(fps)], names=["id", "text_hash", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text_hash`` and ``fp`` (the 64 bits as a signed bigint) of every document."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "id bigint, text_hash bigint, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _block_masks(free: int, blocks: int) -> list[int]:
    """Masks of each pair of ``blocks`` near-equal blocks of the set bits of ``free``."""
    bits = [i for i in range(64) if free >> i & 1]
    cuts = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(parts, 2)]


def _parts(masks: list[tuple[int, int]]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint")).alias("root"))
                               for i, m in masks]))


def index_parts(distinct: DataFrame, radius: int, split_rows: int) -> DataFrame:
    """``mask``, ``root`` and ``fp``: each fingerprint in every part of the index it belongs to."""
    first = list(enumerate(_block_masks((1 << 64) - 1, radius + 2)))
    placed = distinct.select("fp", _parts(first).alias("p")).select("fp", "p.mask", "p.root")
    sizes = placed.groupBy("mask", "root").agg(F.count("*").alias("n"))
    placed = placed.join(sizes.where("n > 1"), ["mask", "root"])  # a part of one has no links
    small = placed.where(F.col("n") <= split_rows).select("fp", "mask", "root")
    large = placed.where(F.col("n") > split_rows)
    # a large part's fingerprints agree on two of its other bits' blocks as well
    finer = None
    for i, m in first:
        subs = [(len(first) * (i + 1) + j, m | s) for j, s in enumerate(_block_masks(~m & ((1 << 64) - 1), radius + 2))]
        rows = F.when(F.col("mask") == i, F.array(*[F.struct(F.lit(j).alias("mask"), F.col("fp").bitwiseAND(
            F.lit(_signed(x)).cast("bigint")).alias("root")) for j, x in subs]))
        finer = rows if finer is None else F.coalesce(finer, rows)
    fine = large.select("fp", F.explode(finer).alias("p")).select("fp", "p.mask", "p.root")
    return small.unionByName(fine)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence (prefix exclusive-or of its bits)."""
    out = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


def links(codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of Gray-sorted codes that differ in at most ``radius`` bits, by the index's tree."""
    # levels from the leaves up: what all members have set, and where they agree
    ands, ors = [codes], [codes]
    while len(ands[-1]) > FAN:
        at = np.arange(0, len(ands[-1]), FAN)
        ands.append(np.bitwise_and.reduceat(ands[-1], at))
        ors.append(np.bitwise_or.reduceat(ors[-1], at))
    n = len(ands[-1])
    i, j = np.triu_indices(n)
    for level in range(len(ands) - 1, -1, -1):
        low, agree = ands[level], ~(ands[level] ^ ors[level])
        near = np.bitwise_count((low[i] ^ low[j]) & agree[i] & agree[j]) <= radius
        i, j = i[near], j[near]
        if level:
            n = len(ands[level - 1])
            a = (i[:, None] * FAN + np.repeat(np.arange(FAN), FAN)).ravel()
            b = (j[:, None] * FAN + np.tile(np.arange(FAN), FAN)).ravel()
            own = (a < n) & (b < n) & (a <= b)
            i, j = a[own], b[own]
    return i[i < j], j[i < j]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` members the smallest member it is linked with, over any number of links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _part_edges(radius: int):
    def search(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        root = forest(len(codes), *links(codes, radius))
        own = np.flatnonzero(root != np.arange(len(codes)))
        return codes[own], codes[root[own]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None  # fingerprints of the part that is still open

        def edges(found: list) -> pa.RecordBatch:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])

        for batch in batches:
            mask, root, fp = (column(batch, c).to_numpy(zero_copy_only=False) for c in ("mask", "root", "fp"))
            if not len(fp):
                continue
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (root[1:] != root[:-1])) + 1
            found = []
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)]):
                if (mask[a], root[a]) != key:
                    if sum(map(len, held)) > 1:
                        found.append(search(np.concatenate(held)))
                    held, key = [], (mask[a], root[a])
                held.append(fp[a:z].view(np.uint64))
            found = [x for x in found if len(x[0])]
            if found:
                yield edges(found)
        if sum(map(len, held)) > 1:
            yield edges([search(np.concatenate(held))])
    return run


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for the nodes of undirected edges ``u``, ``v``.

    Large-star and small-star rounds; every round's edges are written to the shared folder.
    """
    def star(both: DataFrame, up: bool) -> DataFrame:
        # the smallest neighbour is a partial sum; edges meet it in a join, which splits hot nodes
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(low, "u")
        out = joined.where(F.col("v") > F.col("u")) if up else joined
        rows = out.select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not up:
            rows = rows.union(low.select("u", F.col("m").alias("v")))
        return rows.where("u <> v").distinct()

    edges = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = star(both, up=True)
        edges = materialise(star(edges.where("v < u"), up=False), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(docs: DataFrame, shingle: int, radius: int, id_col: str = "doc_id", text_col: str = "text",
                    split_rows: int = 4096) -> DataFrame:
    """One row per document: ``id``, ``text_hash``, ``fp``, ``root`` (its component's name) and ``component_id``.

    ``component_id`` is the smallest id reachable over links within ``radius`` bits.
    """
    fps = materialise(fingerprints(docs, shingle, id_col, text_col), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("id").alias("rep"))
    parts = index_parts(distinct.select("fp"), radius, split_rows)
    edges = (parts.repartition("mask", "root").sortWithinPartitions("mask", "root")
             .mapInArrow(_part_edges(radius), "u bigint, v bigint"))
    comp = components(edges)
    joined = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = joined.select("fp", "root").join(lowest, "root")
    return fps.join(named, "fp").select("id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int, radius: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id's (a null id only if there is no other).

    Rows that repeat that id and text are one document, of which one row stays.  The texts are shuffled once.
    """
    found = near_duplicates(docs, shingle, radius, id_col, text_col)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("_sh_null"), F.coalesce("id", F.lit(0)).alias("_sh_id"),
                                                     F.col("text_hash").alias("_sh_hash"))).alias("first"))
    own = F.col(id_col).cast("bigint")
    keys = ["_sh_null", "_sh_id", "_sh_hash"]
    rows = (docs.withColumn("_sh_null", own.isNull()).withColumn("_sh_id", F.coalesce(own, F.lit(0)))
            .withColumn("_sh_hash", F.xxhash64(text_col)))
    kept = rows.join(first.select("first.*"), keys, "left_semi")
    one = Window.partitionBy(*keys).orderBy(*keys)
    return kept.withColumn("_sh_row", F.row_number().over(one)).where("_sh_row = 1").select(*docs.columns)


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
