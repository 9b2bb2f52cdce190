"""Document fingerprints: a Merkle tree over sections and paragraphs.

A text is cut into paragraphs at line ends; a section ends after a blank paragraph or one whose digest
is 0 modulo ``SECTION_MOD``, so cuts depend on content and an edit moves no distant cut.  A paragraph's node
hashes its bytes, a section's its paragraphs' nodes, the root its sections' nodes: equal roots mean equal
texts.  A paragraph also lists short digests of its pieces (sentences, cut at ``PIECE`` bytes), so that edits
inside a paragraph are located and likeness is measured below it.

Fingerprint: ``root`` (32 hex digits), then for each section ``/`` and 16 hex digits, for each of its paragraphs
``;`` and 16 hex digits, and 8 for each of its pieces (6 of the digest, 2 of the length in bytes).

Defined cases: a null text counts as empty; the empty text has one empty paragraph and no pieces; two texts
without pieces are alike (1.0) if equal; repeated rows keep their place in the order (ties of the id by
the text's hash); a null id sorts as the smallest; the only document is its own successor; an empty table
gives an empty result; only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenweave.functions.common import bounded_collect, ship_by_value
from tokenweave.llm.common import column

ship_by_value(__name__)

SECTION_MOD = 8
PIECE = 64
_PIECES = re.compile(rb"[^.!?\n]{1,%d}[.!?]{0,8}|[.!?]{1,8}" % PIECE)
MAX_BINS = 100_000


def _node(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def fingerprint(text: str) -> str:
    """The serialised tree of a text."""
    out, sections, members, body = [], [], [], []
    digest = xxhash.xxh32_hexdigest

    def close() -> None:
        node = _node(b"".join(members))
        sections.append(node)
        out.append("/" + node[:8].hex() + "".join(body))
        members.clear()
        body.clear()

    for par in text.encode().split(b"\n"):
        node = _node(par)
        members.append(node)
        body.append(";" + node[:8].hex())
        body += [f"{digest(p)[:6]}{len(p):02x}" for p in _PIECES.findall(par)]
        if not par or node[0] % SECTION_MOD == 0:
            close()
    if members:
        close()
    return _node(b"\x01" + b"".join(sections)).hex() + "".join(out)


def parse(fp: str) -> list[tuple[str, list[tuple[str, list[str]]]]]:
    """Sections of a fingerprint: (node, paragraphs), a paragraph being (node, pieces)."""
    tree = []
    for section in fp[32:].split("/")[1:]:
        node, *pars = section.split(";")
        tree.append((node, [(p[:16], [p[i:i + 8] for i in range(16, len(p), 8)]) for p in pars]))
    return tree


def pieces(fp: str) -> list[str]:
    """All piece digests of a fingerprint."""
    return [p[i:i + 8] for p in fp[32:].replace("/", ";/").split(";") if p[:1] != "/" for i in range(16, len(p), 8)]


def likeness(a: str, b: str) -> float:
    """Share of the two texts' bytes that stand in pieces they have in common (0 to 1)."""
    if a[:32] == b[:32]:
        return 1.0
    x, y = Counter(pieces(a)), Counter(pieces(b))
    size = lambda c: sum(int(p[6:], 16) * n for p, n in c.items())
    total = size(x) + size(y)
    return 2.0 * size(x & y) / total if total else 0.0


def changed_ranges(a: str, b: str) -> list[tuple[int, int]]:
    """Byte ranges of ``b``'s text in pieces that ``a`` lacks, found down the branches that differ."""
    if a[:32] == b[:32]:
        return []
    tree = parse(a)
    sections = {n for n, _ in tree}
    pars = {n for _, ps in tree for n, _ in ps}
    known = {p for _, ps in tree for _, xs in ps for p in xs}
    at, out = 0, []
    for node, ps in parse(b):
        for par, xs in ps:
            for p in xs:
                n = int(p[6:], 16)
                if node not in sections and par not in pars and p not in known:
                    if out and out[-1][1] == at:
                        out[-1] = (out[-1][0], at + n)
                    else:
                        out.append((at, at + n))
                at += n
            at += 1  # the line end
    return out


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows in bins of descending id, each bin followed by a copy of the row that follows its last one.

    Bin bounds are quantiles of the ids.  An id that holds several of them, and rows without an id, are divided further
    by the hash of the text, which orders rows of one id.  A bin's first row goes to the bin before it as well (the
    very first row to the last bin), so every row meets its successor in one task and the texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select(F.col("id").cast("double").alias("d"))
    quantiles = Counter(ids.approxQuantile("d", [i / n for i in range(1, n)], 0.25 / n))
    bounds = sorted(quantiles)
    # the bounds at or above the id are counted in two steps, first every 64th
    coarse = F.array(*[F.lit(b) for b in bounds[::64]]).cast("array<double>")
    fine = F.array(*[F.lit(b) for b in bounds]).cast("array<double>")
    d = F.col("id").cast("double")
    block = F.size(F.filter(coarse, lambda b: b < d))
    under = F.greatest(block - 1, F.lit(0)) * 64
    below = under + F.size(F.filter(F.slice(fine, under + 1, F.lit(64)), lambda b: b < d))
    # a frequent id is the largest of its bin, so its parts come first; doubles name ids exactly below 2**53
    frequent = [F.lit(x) for b, k in quantiles.items() if k > 1 and abs(b) < 1 << 53 for x in (b, k)]
    shares = F.coalesce(F.element_at(F.create_map(*frequent), d), F.lit(0)) if frequent else F.lit(0)
    part = lambda k: F.least(F.floor((F.col("hash") / F.lit(2.0 ** 64) + 0.5) * k), k - 1)
    base = F.when(d.isNull(), F.lit(len(bounds) + 1)).otherwise(F.lit(len(bounds)) - below).cast("bigint") * (n + 1)
    inside = F.when(d.isNull(), part(F.lit(n))).when(shares > 0, part(shares)).otherwise(F.lit(n))
    binned = (rows.withColumn("hash", F.xxhash64("text")).withColumn("bin", base + inside)
              .withColumn("first", F.struct(F.col("id").isNull().alias("none"), F.bitwise_not("id").alias("down"), "hash")))
    tops = sorted(bounded_collect(binned.groupBy("bin").agg(F.min("first").alias("top")), MAX_BINS, "bins"), key=lambda r: r[0])
    if not tops:
        return rows.select("id", "text", F.lit(0).alias("bin"), F.lit(False).alias("copy"))
    order = [r.bin for r in tops]
    plan = spark.createDataFrame([(r.bin, r.top, goes) for r, goes in zip(tops, [order[-1], *order])], T.StructType([
        T.StructField("bin", T.LongType()), T.StructField("top", binned.schema["first"].dataType), T.StructField("goes", T.LongType())]))
    here = F.struct(F.col("bin").alias("bin"), F.lit(False).alias("copy"))
    there = F.struct(F.col("goes").alias("bin"), F.lit(True).alias("copy"))
    placed = binned.join(F.broadcast(plan), "bin").withColumn("place", F.explode(  # at most MAX_BINS rows
        F.when(F.col("first").eqNullSafe(F.col("top")), F.array(here, there)).otherwise(F.array(here))))
    return (placed.select("id", "text", "place.bin", "place.copy", "hash").repartition("bin")
            .sortWithinPartitions("bin", "copy", F.col("id").desc_nulls_last(), "hash").drop("hash"))


RESULT = ("id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, edited_ranges int")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_ranges"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()]
    schema = pa.schema(list(zip(names, types)))
    last, rows, held = None, [], 0  # last: the row that waits for its successor
    for batch in batches:
        texts = column(batch, "text")
        meta = zip(*(column(batch, c).to_pylist() for c in ("id", "bin", "copy")))
        for i, (key, at, copy) in enumerate(meta):
            if copy and (last is None or last[1] != at):
                continue  # a further row with the id of the first copy
            text = texts[i].as_py()
            fp = fingerprint(text)
            if last is not None and last[1] == at:
                own, _, mine, tree = last
                half = len(mine) // 2
                edited = mine[:len(mine) - half] + text[:half]
                new = tree if edited == mine else fingerprint(edited)
                rows.append((own, len(mine), hashlib.sha256(edited.encode()).hexdigest(), tree, new,
                             likeness(tree, new), likeness(tree, fp), len(changed_ranges(tree, new))))
                held += len(tree) + len(new)
            last = None if copy else (key, at, text, fp)
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)
                rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)


def fingerprint_successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last half of the code points replaced by as many of the first ones of the
    document that follows in descending id (after the last: the first).
    """
    out = _in_order(docs, id_col, text_col).mapInArrow(_compare, RESULT)
    return out.withColumnRenamed("id", id_col)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = [fingerprint(t or "") for t in column(b, "text").to_pylist()]
        yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(fps, pa.string())], names=["id", "fingerprint"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fingerprint`` of every document; no shuffle."""
    return (docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(_fingerprints, "id bigint, fingerprint string").withColumnRenamed("id", id_col))
