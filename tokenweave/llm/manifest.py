"""Merkle manifest of a dataset, proved leaf by leaf with octopus multiproofs.

A leaf is the hash of a row's columns.  The leaves of a source stand in the order of their ids; every ``FAN``
consecutive nodes are hashed to their parent until one is left, the source's root.  The source roots, in the order of the
sources, make the top tree in the same way.

A proof needs, for each level, the other nodes of the leaf's run.  Leaves are proved a block at a time: the task that
holds a block of ``BLOCK`` leaves computes the least union of nodes that its proofs miss and its own leaves do not give
(the octopus), these are fetched once for the block, all shared interior nodes are derived from both, and each proof
is expanded from them in the task.  So what moves for a block of 4,096 proofs are some hundred nodes, not some hundred
nodes a proof.

Scale: leaves are numbered by a range sort over (source, id, leaf), so a source with a third of all rows is spread like
any other; rows that are equal in every column are counted first and numbered by copy.  Three levels are built in one
pass over blocks of bounded size, so the shuffles are few and shrink by a factor of 4,096.  Sources and the nodes above
the blocks are broadcast only after a count.

Defined cases: a null column is hashed as ``-``; a null source is a source of its own and comes first, a null id comes
first in its source; rows of one id are ordered by their leaf; rows that repeat in all columns are leaves of their own;
an empty table has no root and no rows; a source with one leaf has that leaf as its root; texts of any length are hashed
on the JVM; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenweave.functions.common import broadcast_if_small, ship_by_value
from tokenweave.llm.common import materialise, numbered_copies, place_in_groups

ship_by_value(__name__)

FAN = 16
BLOCK_LEVELS = 3
BLOCK = FAN ** BLOCK_LEVELS
TOP = -1  # the tree over the sources
NODE = "tree bigint, n bigint, level int, place bigint, hash string"
BROADCAST_NODES = 500_000


def row_hash(columns: list[Column]) -> Column:
    """Hash of a row: each column as ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def levels_of(n: int) -> int:
    """How many times the nodes of a tree of ``n`` leaves are hashed to their parents."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def width_of(n: int, level: int) -> int:
    return -(-n // FAN ** level)


def _hash(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def build_block(first: int, hashes: list[bytes], n: int, levels: int) -> Iterator[tuple[int, int, bytes]]:
    """``(levels up, place, hash)`` of the nodes over consecutive nodes of one level, ``n`` wide in all.

    ``first`` is a multiple of ``FAN ** levels``; the nodes reach that far or to the level's end.
    """
    for up in range(1, levels + 1):
        if n <= 1:
            return
        hashes = [_hash(b"".join(hashes[i:i + FAN])) for i in range(0, len(hashes), FAN)]
        first, n = first // FAN, -(-n // FAN)
        for i, h in enumerate(hashes):
            yield up, first + i, h


def missing_nodes(places: list[int], n: int) -> list[tuple[int, int]]:
    """The octopus: ``(level, place)`` of the least set of nodes from which, with the leaves at ``places`` of ``n``, the
    root and every proof follow."""
    out, known = [], set(places)
    for level in range(levels_of(n)):
        width, runs = width_of(n, level), {p // FAN for p in known}
        for r in sorted(runs):
            out += [(level, p) for p in range(r * FAN, min(width, (r + 1) * FAN)) if p not in known]
        known = runs
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows that agree in ``keys``; a group has at most a block's rows and its fetched nodes."""
    key, held = None, []
    for b in batches:
        for row in b.to_pylist():
            k = tuple(row[x] for x in keys)
            if k != key and held:
                yield key, held
                held = []
            key = k
            held.append(row)
    if held:
        yield key, held


def _build(level: int):
    def batch(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=["tree", "n", "level", "place", "hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, _), rows in _groups(batches, ["tree", "block"]):
            n, hashes = rows[0]["n"], [r["hash"].encode() for r in rows]
            out += [(tree, n, level + up, p, h.decode())
                    for up, p, h in build_block(rows[0]["place"], hashes, width_of(n, level), BLOCK_LEVELS)]
            if len(out) >= 10_000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)
    return run


def _blocks(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def build_nodes(leaves: DataFrame, widest: int, what: str) -> DataFrame:
    """Inner nodes (``tree``, ``n``, ``level`` from 1, ``place``, ``hash``) over ``leaves`` (``tree``, ``n``, ``place``, ``hash``)."""
    rows, level, out = leaves, 0, None
    while width_of(widest, level) > 1:
        block = rows.where(F.col("n") > FAN ** level).select("tree", "n", "place", "hash", F.expr(f"place div {BLOCK}").alias("block"))
        nodes = materialise(_blocks(block, "place").mapInArrow(_build(level), NODE), what)
        out = nodes if out is None else out.unionByName(nodes)
        level += BLOCK_LEVELS
        rows = nodes.where(F.col("level") == level)
    return leaves.sparkSession.createDataFrame([], NODE) if out is None else out


@dataclass
class Manifest:
    """``leaves``: ``tree``, ``n``, ``place``, ``hash`` and the columns carried along; ``nodes``: inner nodes of all trees;
    ``sources``: ``source``, ``tree`` (its place in the order of sources), ``n`` and ``subroot``; ``root`` and ``n_sources``."""

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    root: str | None
    n_sources: int


def build_manifest(rows: DataFrame, carry: list[str]) -> Manifest:
    """The manifest of ``rows``: ``id``, ``source``, ``leaf`` and columns ``carry`` that follow from these."""
    spark = rows.sparkSession
    single = materialise(numbered_copies(rows, ["id", "source", "leaf"], {c: F.min(c) for c in carry}), "leaves")
    counts = single.groupBy("source").agg(F.count("*").alias("n"))
    sources = materialise(place_in_groups(counts, [], ["source"], "sources").withColumnRenamed("place", "tree"), "sources")
    n_sources, widest = sources.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    if n_sources >= BROADCAST_NODES:  # many sources: a join in which AQE splits the rows of a hot one
        named = single.join(sources, single["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    else:
        named = single.join(F.broadcast(sources.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    placed = place_in_groups(named.select("tree", "n", "id", "copy", F.col("leaf").alias("hash"), *carry),
                             ["tree"], ["id", "hash", "copy"], "placed-leaves").drop("copy")
    leaves = materialise(placed, "leaves")
    inner = build_nodes(leaves.select("tree", "n", "place", "hash"), widest, "manifest-nodes")
    # the last level of a tree has one node; a lone leaf is its own root
    tops = inner.where("place = 0").groupBy("tree").agg(F.max_by("hash", "level").alias("subroot"))
    lone = leaves.where("n = 1").select("tree", F.col("hash").alias("subroot"))
    sources = materialise(sources.join(tops.unionByName(lone), "tree"), "sources")
    top_leaves = sources.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(n_sources).cast("bigint").alias("n"), F.lit(0).alias("level"),
                                F.col("tree").alias("place"), F.col("subroot").alias("hash"))
    over = top_leaves.unionByName(build_nodes(top_leaves, n_sources, "manifest-top"))
    top = over.where("place = 0").orderBy(F.desc("level")).select("hash").first()
    return Manifest(leaves, inner.unionByName(over), sources, top and top[0], n_sources)


def _requests(n_sources: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), rows in _groups(batches, ["tree", "block"]):
            need = [(tree, block, tree, *x) for x in missing_nodes([r["place"] for r in rows], rows[0]["n"])]
            need += [(tree, block, TOP, *x) for x in missing_nodes([tree], n_sources)]
            if need:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*need), kinds)],
                                                 names=["tree", "block", "of", "level", "at"])
    return run


class _Runs:
    """Runs of siblings on the way up from a block's leaves, as bytes, with the parents derived from them."""

    def __init__(self, known: dict[int, bytes], tree: int, n: int, fetched: dict[tuple, bytes]):
        self.levels: list[dict[int, bytes]] = []
        for level in range(levels_of(n)):
            width, runs = width_of(n, level), {}
            for r in {p // FAN for p in known}:
                own = range(r * FAN, min(width, (r + 1) * FAN))
                runs[r] = b"".join([known[p] if p in known else fetched[tree, level, p] for p in own])
            self.levels.append(runs)
            known = {r: _hash(data) for r, data in runs.items()}
        self.root = known

    def path(self, place: int) -> list[tuple[bytes, bytes]]:
        """What stands before and after the node at ``place`` in its run, and so on up."""
        out = []
        for runs in self.levels:
            run, at = runs[place // FAN], place % FAN * 64
            out.append((run[:at], run[at + 64:]))
            place //= FAN
        return out


PROVED = "hash string, root string, proof_sha256 string, folded_root string"


def _expand(n_sources: int, root: str, carry: list[str]):
    names = ["tree", *carry, "hash", "root", "proof_sha256", "folded_root"]
    kinds = [pa.int64()] * (1 + len(carry)) + [pa.string()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _), rows in _groups(batches, ["tree", "block"]):
            fetched = {(r["of"], r["level"], r["place"]): r["hash"].encode() for r in rows if r["of"] is not None}
            leaves = [r for r in rows if r["of"] is None]
            own = _Runs({r["place"]: r["hash"].encode() for r in leaves}, tree, leaves[0]["n"], fetched)
            over = _Runs({tree: own.root[0]}, TOP, n_sources, fetched)
            shared, derived = over.path(tree), over.root[0].decode()
            out = []
            for r in leaves:
                path = own.path(r["place"]) + shared
                proof, folded = hashlib.sha256(b"".join([x for pair in path for x in pair])).hexdigest(), derived
                if r["claim"] is not None and r["claim"] != r["hash"]:  # the block's own leaf gives the derived nodes
                    value = r["claim"].encode()
                    for before, after in path:
                        value = _hash(before + value + after)
                    folded = value.decode()
                out.append((tree, *[r[c] for c in carry], r["hash"], root, proof, folded))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)
    return run


def prove(m: Manifest, claim: Column, carry: list[str], wanted: Column | None = None) -> DataFrame:
    """Proofs of the leaves of a manifest: ``tree``, ``carry`` (bigint columns), ``hash``, ``root``, ``proof_sha256``
    (hash of the siblings, from the leaf up) and ``folded_root``, which follows from the leaf ``claim`` (null: the leaf
    itself) and the original siblings.  ``wanted`` chooses the leaves to prove (all)."""
    schema = "tree bigint, " + "".join(f"{c} bigint, " for c in carry) + PROVED
    if m.root is None:
        return m.leaves.sparkSession.createDataFrame([], schema)
    asked = m.leaves if wanted is None else m.leaves.where(wanted)
    asked = asked.select("tree", "n", "place", "hash", F.expr(f"place div {BLOCK}").alias("block"), claim.alias("claim"), *carry)
    need = _blocks(asked.select("tree", "block", "place", "n"), "place").mapInArrow(
        _requests(m.n_sources), "tree bigint, block bigint, of bigint, level int, at bigint")
    store = m.nodes.select("tree", "level", "place", "hash")
    if wanted is None:  # whole blocks: nothing below their tops is missing
        store = store.where((F.col("level") >= BLOCK_LEVELS) | (F.col("tree") == TOP))
    else:
        store = store.unionByName(m.leaves.select("tree", F.lit(0).alias("level"), "place", "hash"))
    store = store.select(F.col("tree").alias("of"), "level", F.col("place").alias("at"), "hash")
    got = need.join(broadcast_if_small(store, BROADCAST_NODES), ["of", "level", "at"])
    null = lambda t: F.lit(None).cast(t)
    fetched = got.select("tree", null("bigint").alias("n"), F.col("at").alias("place"), "hash", "block", null("string").alias("claim"),
                         *[null("bigint").alias(c) for c in carry], "of", "level")
    both = fetched.unionByName(asked.withColumn("of", null("bigint")).withColumn("level", null("int")))
    return _blocks(both, "place").mapInArrow(_expand(m.n_sources, m.root, carry), schema)
