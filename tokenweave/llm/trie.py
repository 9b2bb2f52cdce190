"""Prefix trie of conversations, rolled up over a centroid decomposition.

A node is a distinct sequence of first turns; it is known by its smallest member and its depth.  Turns are numbered within
their conversations by a range sort, every prefix gets a key that is a running sum of hashes of (place, turn), and equal
keys are one node.  A node's weight is the number of member rows in its subtree, known from grouping alone; weights laid
end to end give every node an interval that contains those of its subtree, so "is below" is a comparison of numbers.

``rollup`` sums values over subtrees of any such forest, however deep or wide.  A component over ``part_rows`` nodes is cut
at its centroid, the deepest node whose weight within the component is over half of the component's: the total of the
centroid's subtree is added to the nodes on the path from it to the component's top, the centroid is done, what is above
it is one component, and its children's subtrees are dealt to at most ``BINS`` more.  Each step at least halves a
component or divides a group of siblings, so the number of rounds follows the logarithm of the size and not the depth.
A round is a few grouped sums over the nodes; small components are finished in tasks by the same recursion in numpy.

Scale: a conversation that holds a third of all turns is numbered in parts and summed in blocks of ``BLOCK`` turns;
a prefix that many conversations share is counted in the map tasks, and meets their rows through a checked broadcast of the
hot nodes.  Lists of conversation numbers are joined to pieces before one task hashes a node's list as a stream.

Defined cases: a null role or text is empty text; a null turn is first; turns of one number are ordered by the MD5 of their
content; repeated rows are turns of their own; rows without a conversation belong to none and are left out; a conversation
without turns left is a member of the root only; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenweave.functions.common import broadcast_if_small, idiv, ship_by_value
from tokenweave.llm.common import WORD, column, materialise, numbered_copies, place_in_groups

ship_by_value(__name__)

BLOCK = 4096
PART_ROWS = 4096
BINS = 16
HOT = 4096
BROADCAST = 500_000
LANE = 1 << 50  # key lanes are below, so a block's sum fits a bigint
KEY = ["depth", "a", "b"]


def turn_code(role: Column, text: Column) -> Column:
    """Content of a turn, as a hash: the role's length tells role and text apart."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv``, ``place`` (from 0), ``code`` and ``words`` of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", turn_code(role, text).alias("code"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
    single = numbered_copies(turns, ["conv", "turn", "code", "words"])
    return place_in_groups(single, ["conv"], ["turn", "code", "copy"], "turns").drop("turn", "copy")


def _block(place: Column) -> Column:
    return idiv(place, BLOCK)


def rebuilt(turns: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv``, ``length``) and their rebuilt turns (these, ``depth`` from 1, ``code``, ``words``).

    The first h turns come from the first conversation of the group, h being the number's crc32 modulo ``heads``.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    base = F.col("conv") - F.col("conv") % group
    convs = turns.groupBy("conv").agg(F.count("*").alias("n"))
    have = convs.where(F.col("conv") % group == 0).select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.withColumn("h", h).withColumn("base", base).join(have, "base", "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0))).cast("bigint")
    convs = materialise(convs.select("conv", "n", "h", "base", taken.alias("taken"),
                                     (taken + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length")), "conversations")
    first = turns.where((F.col("conv") % group == 0) & (F.col("place") < heads - 1)).select(
        F.col("conv").alias("base"), F.col("place").alias("at"), "code", "words")
    head = (convs.where("taken > 0").select("conv", "length", "base", F.explode(F.expr("sequence(0L, taken - 1)")).alias("at"))
            .join(first, ["base", "at"]).select("conv", "length", (F.col("at") + 1).alias("depth"), "code", "words"))
    # one row a block of turns, so that a long conversation meets its shift in as many tasks
    shift = convs.select("conv", "length", (F.col("taken") - F.col("h")).alias("shift"), F.explode(F.expr(f"sequence(0L, (n - 1) div {BLOCK})")).alias("blk"))
    own = (turns.where(F.col("place") >= h).withColumn("blk", _block(F.col("place"))).join(shift, ["conv", "blk"])
           .select("conv", "length", (F.col("place") + F.col("shift") + 1).alias("depth"), "code", "words"))
    return convs.select("conv", "length"), head.unionByName(own)


def running_sums(rows: DataFrame, names: list[str], modulus: int | None = None) -> DataFrame:
    """``rows`` with sums of ``names`` up to ``depth`` in the row's conversation (``_sum`` appended), by blocks of turns."""
    rows = rows.withColumn("blk", _block(F.col("depth")))
    inside = Window.partitionBy("conv", "blk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    low = lambda c: c if modulus is None else c % modulus
    totals = rows.groupBy("conv", "blk").agg(*[F.sum(c).alias(c) for c in names])
    bases = totals.select("conv", "blk", *[low(F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")).over(before), F.lit(0).cast("decimal(38,0)")))
                                           .cast("bigint").alias(f"_{c}") for c in names])
    out = rows.select("*", *[F.sum(c).over(inside).alias(f"_{c}_in") for c in names]).join(bases, ["conv", "blk"])
    kept = [c for c in rows.columns if c != "blk"]
    return out.select(*kept, *[low(low(F.col(f"_{c}_in")) + F.col(f"_{c}")).cast("bigint").alias(f"{c}_sum") for c in names])


def _meet(rows: DataFrame, nodes: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Join rows with their nodes; nodes that over ``HOT`` rows meet are broadcast (if few, by a count), the rest shuffled."""
    hot = broadcast_if_small(nodes.where(F.col(size) > HOT), BROADCAST)
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(nodes.where(F.col(size) <= HOT), keys)
    return rows.join(hot, keys).unionByName(cold)


def trie_nodes(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and the conversations that end at each.

    Nodes: ``tin`` (start of the interval), ``size`` (its length, the subtree's weight), ``parent`` (the parent's ``tin``,
    -1 for the root), ``conv`` (smallest member), ``depth``, ``parent_conv``, ``n`` (members) and ``words``.
    Ends: ``tin`` and ``conv``.
    """
    mark = F.md5(F.concat_ws(":", "depth", "code").cast("binary"))
    lane = lambda i: F.conv(F.substring(mark, i, 12), 16, 10).cast("bigint") % LANE
    keyed = running_sums(turns.withColumn("a", lane(1)).withColumn("b", lane(13)), ["a", "b"], LANE)
    prev = lambda c: F.pmod(F.col(f"{c}_sum") - F.col(c), F.lit(LANE)).alias(f"{c}_up")
    rows = keyed.select("conv", "depth", "length", "words", prev("a"), prev("b"), F.col("a_sum").alias("a"), F.col("b_sum").alias("b"))
    rows = materialise(rows, "prefixes")
    nodes = materialise(rows.groupBy(*KEY).agg(
        F.count("*").alias("n"), F.min("conv").alias("top"), F.sum(F.expr("length - depth + 1")).alias("size"),
        F.min("words").alias("words"), F.min("a_up").alias("a_up"), F.min("b_up").alias("b_up")), "nodes")
    root = convs.agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.sum(F.col("length") + 1).alias("size")).first()
    # siblings end to end behind the parent's own weight
    up = nodes.select("*", (F.col("depth") - 1).alias("up_depth"))
    offset = place_in_groups(up, ["up_depth", "a_up", "b_up"], ["a", "b"], "siblings", weight="size")
    offset = offset.select(*KEY, "top", "n", F.col("place").alias("off"))
    path = materialise(_meet(rows.select("conv", "length", *KEY), offset, KEY, "n").select("conv", "length", "depth", "top", "n", "off"), "paths")
    # a child's interval starts behind the members of its parent
    above = path.select("conv", (F.col("depth") + 1).alias("depth"), F.col("n").alias("up_n"), F.col("top").alias("up_top"))
    step = path.join(above, ["conv", "depth"], "left").withColumn("off", F.col("off") + F.coalesce("up_n", F.lit(root["n"])))
    at = running_sums(step, ["off"]).withColumnRenamed("off_sum", "tin")
    at = materialise(at, "intervals")
    own = at.where("conv = top").withColumnRenamed("depth", "d")
    sized = nodes.select(F.col("top"), F.col("depth").alias("d"), "size", "words")
    out = own.join(sized, ["top", "d"]).select("tin", "size", (F.col("tin") - F.col("off")).alias("parent"), "conv", F.col("d").alias("depth"),
                                               F.coalesce("up_top", F.lit(root["conv"])).alias("parent_conv"), "n", "words")
    ends = at.where("depth = length").select("tin", "conv").unionByName(convs.where("length = 0").select(F.lit(0).cast("bigint").alias("tin"), "conv"))
    if root["n"]:
        out = out.unionByName(out.sparkSession.createDataFrame(
            [(0, root["size"], -1, root["conv"], 0, None, root["n"], 0)],
            "tin bigint, size bigint, parent bigint, conv bigint, depth bigint, parent_conv bigint, n bigint, words bigint"))
    return materialise(out, "trie"), ends


def _local(values: list[str]):
    """Finish small components: the same recursion over all components of a batch at once."""
    def solve(comp, attach, tin, size, span, parent, own, vals, acc):
        # components begin as groups of siblings: every tree a component of its own
        order = np.lexsort((tin, comp))
        comp, attach, tin, size, span, parent, own, vals, acc = (x[order] for x in (comp, attach, tin, size, span, parent, own, vals, acc))
        label, active = np.cumsum(parent == attach), np.arange(len(tin))
        while len(active):
            lab, t, s = label[active], tin[active], size[active]
            first = np.flatnonzero(np.r_[True, lab[1:] != lab[:-1]])
            seg = np.cumsum(np.r_[True, lab[1:] != lab[:-1]]) - 1
            total = np.add.reduceat(own[active], first)
            at = np.maximum.reduceat(np.where(2 * s > total[seg], np.arange(len(t)), -1), first)  # the deepest is the last
            c = at[seg]
            below = (t > t[c]) & (t < t[c] + span[active][c])
            above = (t < t[c]) & (t[c] < t + span[active])
            centre = np.zeros(len(t), bool)
            centre[at] = True
            summed = np.add.reduceat(np.where((below | centre)[:, None], vals[active], 0), first, axis=0)
            grown = above | centre
            acc[active[grown]] += summed[seg[grown]]
            size[active[above]] -= s[at][seg[above]]
            child = below & (parent[active] == t[c])
            new = np.where(below, len(first) + np.cumsum(child), seg)
            keep = ~centre
            active, new = active[keep], new[keep]
            order = np.argsort(new, kind="stable")
            active = active[order]
            label[active] = new[order]
        return tin, acc

    names = ["comp", "attach", "tin", "left", "size", "parent", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(t: pa.Table) -> pa.RecordBatch:
            comp, attach, tin, left, span, parent, own = (t[n].to_numpy() for n in names)
            vals = np.stack([t[v].to_numpy() for v in values], axis=1)
            acc = np.stack([t[f"{v}_acc"].to_numpy() for v in values], axis=1)
            tin, acc = solve(comp, attach, tin, left, span, parent, own, vals, acc)
            return pa.RecordBatch.from_arrays([pa.array(tin), *[pa.array(np.ascontiguousarray(acc[:, i])) for i in range(len(values))]],
                                              names=["tin", *values])

        for b in batches:
            if not b.num_rows:
                continue
            comp = column(b, "comp").to_numpy()
            cut = int(np.searchsorted(comp, comp[-1]))  # rows before the last component, which may go on
            if held and (cut or column(held[0], "comp")[0].as_py() != comp[-1]):
                held.append(b.slice(0, cut))
                yield out(pa.Table.from_batches(held))
                held = [b.slice(cut)]
            elif cut:
                yield out(pa.Table.from_batches([b.slice(0, cut)]))
                held = [b.slice(cut)]
            else:
                held.append(b)
        if held:
            yield out(pa.Table.from_batches(held))
    return run


def rollup(nodes: DataFrame, values: list[str], part_rows: int = PART_ROWS, max_rounds: int = 400) -> DataFrame:
    """``tin`` and the sums of ``values`` (bigint) over every node's subtree.

    ``nodes``: ``tin`` and ``size`` (interval, the subtree's weight), ``n`` (own weight, 1 at least) and ``parent`` (its
    ``tin``, -1 for a root).
    """
    zero = F.lit(0).cast("bigint")
    rows = materialise(nodes.select("tin", "size", F.col("size").alias("left"), "n", "parent", *values, *[zero.alias(f"{v}_acc") for v in values],
                                    zero.alias("comp"), F.lit(-1).cast("bigint").alias("attach")), "forest")
    done = []
    for _ in range(max_rounds):
        sizes = rows.groupBy("comp").agg(F.count("*").alias("rows"), F.sum("n").alias("total"))
        large = materialise(sizes.where(F.col("rows") > part_rows), "large")
        if not large.limit(1).count():
            break
        large = broadcast_if_small(large, BROADCAST)
        small = rows.join(large.select("comp"), "comp", "left_anti")
        # the centroid: of the path of nodes over half the weight, the deepest
        part = rows.join(large, "comp")
        best = part.groupBy("comp").agg(F.max(F.when(F.col("left") * 2 > F.col("total"), F.struct("tin", "size", "left"))).alias("c"))
        centre = large.join(best, "comp").select("comp", F.col("c.tin").alias("c"), F.col("c.size").alias("c_size"), F.col("c.left").alias("c_left"))
        part = rows.join(broadcast_if_small(materialise(centre, "centres"), BROADCAST), "comp")
        below = F.coalesce((F.col("tin") > F.col("c")) & (F.col("tin") < F.col("c") + F.col("c_size")), F.lit(False))
        above = F.coalesce((F.col("tin") < F.col("c")) & (F.col("c") < F.col("tin") + F.col("size")), F.lit(False))
        part = part.select("*", below.alias("below"), above.alias("above"), F.coalesce(F.col("tin") == F.col("c"), F.lit(False)).alias("centre"))
        # groups of siblings: the centroid's children, or the trees of a component without a centroid
        part = part.withColumn("sibling", (F.col("below") & (F.col("parent") == F.col("c"))) | (F.col("c").isNull() & (F.col("parent") == F.col("attach"))))
        at = F.when(F.col("sibling"), F.col("tin"))
        sums = materialise(part.groupBy("comp").agg(*[F.sum(F.when(F.col("below") | F.col("centre"), F.col(v))).alias(f"{v}_s") for v in values],
                                                    F.min(at).alias("low"), F.max(at).alias("high")), "sums")
        part = part.join(broadcast_if_small(sums, BROADCAST), "comp")
        # dealt by place between the first and the last, which so never share a bin
        bin_ = F.floor((F.col("tin") - F.col("low")) / (F.col("high") - F.col("low") + 1) * BINS)
        starts = (part.where("sibling").groupBy("comp", bin_.alias("bin")).agg(F.min("tin").alias("at"))
                  .groupBy("comp").agg(F.sort_array(F.collect_list("at")).alias("starts")))
        part = part.join(broadcast_if_small(materialise(starts, "starts"), BROADCAST), "comp", "left")
        moved = F.col("below") | F.col("c").isNull()
        start = F.element_at("starts", F.size(F.filter("starts", lambda x: x <= F.col("tin"))))
        gain = [(F.col(f"{v}_acc") + F.when(F.col("above") | F.col("centre"), F.col(f"{v}_s")).otherwise(0)).alias(f"{v}_acc") for v in values]
        new = materialise(part.select(
            "tin", "size", (F.col("left") - F.when(F.col("above"), F.col("c_left")).otherwise(0)).alias("left"), "n", "parent", *values, *gain,
            F.when(moved, start).otherwise(F.col("comp")).alias("comp"), F.when(F.col("below"), F.col("c")).otherwise(F.col("attach")).alias("attach"), "centre"), "split")
        done.append(new.where("centre").select("tin", *[F.col(f"{v}_acc").alias(v) for v in values]))
        rows = materialise(new.where("NOT centre").drop("centre").unionByName(small), "forest")
    else:
        raise RuntimeError(f"components did not fit {part_rows} rows in {max_rounds} rounds")
    schema = "tin bigint" + "".join(f", {v} bigint" for v in values)
    out = rows.repartition("comp").sortWithinPartitions("comp", "tin").mapInArrow(_local(values), schema)
    for d in done:
        out = out.unionByName(d)
    return out


def _join_ids(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tin, conv = column(b, "tin").to_numpy(), column(b, "conv").to_numpy()
            if not len(tin):
                continue
            cuts = np.flatnonzero(tin[1:] != tin[:-1]) + 1
            out = []
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tin)]):
                out += [(tin[i], conv[i], ",".join(map(str, conv[i:min(z, i + limit)].tolist()))) for i in range(a, z, limit)]
            t, first, text = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(first, pa.int64()), pa.array(text)], names=["tin", "first", "ids"])
    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    for b in batches:
        tins, out = column(b, "tin").to_pylist(), []
        for tin, ids in zip(tins, column(b, "ids")):
            if tin != key:
                if digest is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = tin, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_py().encode())
        if out:
            t, h = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(h)], names=["tin", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([digest.hexdigest()])], names=["tin", "ends_sha256"])


def ends_digest(ends: DataFrame, piece: int = BLOCK) -> DataFrame:
    """``tin`` and the hash of the decimal numbers of the conversations that end there, ascending, joined by commas.

    A hash is sequential; a node's numbers are joined to pieces by many tasks first, and one task streams the pieces.
    """
    pieces = (ends.repartitionByRange("tin", "conv").sortWithinPartitions("tin", "conv")
              .mapInArrow(_join_ids(piece), "tin bigint, first bigint, ids string"))
    return pieces.repartition("tin").sortWithinPartitions("tin", "first").mapInArrow(_digest, "tin bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row a node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``."""
    convs, turns = rebuilt(numbered_turns(conversations))
    nodes, ends = trie_nodes(convs, turns)
    children = nodes.where("parent >= 0").groupBy(F.col("parent").alias("tin")).agg(F.count("*").alias("n_children"))
    nodes = materialise(nodes.join(children, "tin", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children")
    values = nodes.select("tin", "size", "n", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"),
                          ((F.col("n") - 1) * F.col("words")).alias("saved_tokens"))
    totals = rollup(values, ["n_leaves", "saved_tokens"], part_rows)
    empty = hashlib.sha256(b"").hexdigest()
    return (nodes.join(totals, "tin").join(ends_digest(ends), "tin", "left")
            .select(F.col("conv").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), F.col("parent_conv").alias("parent_conv_id"),
                    F.col("n").alias("n_convs"), F.col("n_children").cast("bigint").alias("n_children"), "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))
