"""Prefix trie against plain Python, and the rollup on forests of all shapes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from tokenweave.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def forest(parents, rng):
    """Rows (tin, size, n, parent's tin, two values) of a forest given each node's parent (-1: root), parents first."""
    kids = [[] for _ in parents]
    for i, p in enumerate(parents):
        if p >= 0:
            kids[p].append(i)
    n = [rng.randint(1, 5) for _ in parents]
    size = n[:]
    for i in range(len(parents) - 1, -1, -1):
        if parents[i] >= 0:
            size[parents[i]] += size[i]
    tin, at = {}, 0
    for i, p in enumerate(parents):
        if p < 0:
            tin[i], at = at, at + size[i]
    for i in range(len(parents)):
        nxt = tin[i] + n[i]
        for k in kids[i]:
            tin[k], nxt = nxt, nxt + size[k]
    vals = [(rng.randint(0, 9), rng.randint(-5, 10 ** 12)) for _ in parents]
    want = [list(v) for v in vals]
    for i in range(len(parents) - 1, -1, -1):
        if parents[i] >= 0:
            for k in (0, 1):
                want[parents[i]][k] += want[i][k]
    rows = [(tin[i], size[i], n[i], tin[p] if p >= 0 else -1, *vals[i]) for i, p in enumerate(parents)]
    return rows, {tin[i]: tuple(want[i]) for i in range(len(parents))}


SHAPES = {
    "chain": [-1, *range(119)],
    "star": [-1, *[0] * 150],
    "comb": [-1, *[i - 1 if i % 2 else i - 2 if i > 1 else 0 for i in range(1, 120)]],
    "random": [-1, *[random.Random(i).randrange(max(0, i - 30), i) for i in range(1, 250)]],
    "roots": [-1 if i % 3 == 0 else i - 1 for i in range(90)],
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("part_rows", [40, 4096])
def test_rollup(spark, shape, part_rows):
    """Distributed cuts and the recursion in tasks give the plain sums."""
    rows, want = forest(SHAPES[shape], random.Random(7))
    df = spark.createDataFrame(rows, "tin bigint, size bigint, n bigint, parent bigint, x bigint, y bigint").repartition(3)
    got = trie.rollup(df, ["x", "y"], part_rows).collect()
    assert len(got) == len(rows) and {r.tin: (r.x, r.y) for r in got} == want


def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, code, (role, text)))
    convs = {c: [t[3] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for key in nodes:
        if key:
            kids[key[:-1]] = kids.get(key[:-1], 0) + 1
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[:len(key)] == key]
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(key))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), kids.get(key, 0),
                    sum(k not in kids for k in below), sum((len(nodes[k]) - 1) * len(k[-1][1].split()) for k in below if k),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, part_rows=trie.PART_ROWS):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", tin string, depth int").repartition(3)
    return sorted((tuple(r) for r in trie.prefix_trie(df, part_rows).collect()), key=repr)


def random_rows():
    rng, rows = random.Random(4), []
    for c in [*range(64), *rng.sample(range(100, 10 ** 9), 12)]:
        for t in range(rng.randint(1, 6)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "a b", "c", None, "", "é  d\te"])))
    rows += rows[:5]  # repeated rows are turns
    rows += [(None, 0, "user", "lost"), (20, 3, "user", "tie"), (20, 3, "assistant", "tie")]
    rows += [(40, t, "user", f"long {t % 3}") for t in range(10, 70)]  # one long conversation
    return rows


def test_trie_equals_plain(spark, monkeypatch):
    """Small blocks, hot nodes and components, so that every way through the operator is taken."""
    for name, value in (("BLOCK", 8), ("HOT", 5)):
        monkeypatch.setattr(trie, name, value)
    rows = random_rows()
    assert found(spark, rows, part_rows=30) == plain_trie(rows)


def test_no_conversations(spark):
    assert found(spark, []) == [] == found(spark, [(None, 1, "user", "a")])


def test_digest_of_many_ends(spark):
    """A node's list is joined in pieces and hashed as a stream."""
    rows = [(t, c) for t, k in ((0, 1000), (5, 1), (9, 33)) for c in range(k)]
    got = {r.tin: r.ends_sha256 for r in trie.ends_digest(spark.createDataFrame(rows, "tin bigint, conv bigint").orderBy(F.rand(1)), 16).collect()}
    assert got == {t: hashlib.sha256(",".join(map(str, range(k))).encode()).hexdigest() for t, k in ((0, 1000), (5, 1), (9, 33))}
