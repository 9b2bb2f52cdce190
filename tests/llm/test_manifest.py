"""Dataset manifest against a plain tree in Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenweave.llm import manifest
from tokenweave.llm.common import numbered_copies, place_in_groups

SCHEMA = "id bigint, source string, leaf string, claim string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def plain_manifest(rows):
    """(id, leaf, subroot, root, proof, folded) of every row, sorted."""
    key = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    sources = sorted({r[1] for r in rows}, key=key)
    groups = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (key(r[0]), r[2])) for s in sources}
    trees = {s: plain_levels([r[2] for r in g]) for s, g in groups.items()}
    top = plain_levels([trees[s][-1][0] for s in sources]) if sources else []
    out = []
    for t, s in enumerate(sources):
        for i, r in enumerate(groups[s]):
            proof, value = "", r[3] or r[2]
            for levels, at in ((trees[s], i), (top, t)):
                for level in levels[:-1]:
                    run = level[at // 16 * 16:at // 16 * 16 + 16]
                    proof += "".join(h for j, h in enumerate(run) if j != at % 16)
                    value = sha("".join(value if j == at % 16 else h for j, h in enumerate(run)))
                    at //= 16
            out.append((r[0], r[2], trees[s][-1][0], top[-1][0], sha(proof), value))
    return sorted(out, key=repr)


def made(spark, rows):
    return manifest.build_manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), ["claim"])


def proofs(m, wanted=None):
    got = manifest.prove(m, F.col("claim"), ["id"], wanted).join(m.sources.select("tree", "subroot"), "tree")
    return sorted(((r.id, r.hash, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got.collect()), key=repr)


def random_rows(n, sources, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(n)]), rng.choice(sources), sha(str(rng.randrange(n))), None) for _ in range(n)]
    # the claim follows from the other columns
    return [(*r[:3], sha("x" + r[2]) if int(r[2], 16) % 3 == 0 else None) for r in rows]


@pytest.mark.parametrize("rows", [
    [], [(1, "a", sha("1"), None)], [(1, None, sha("1"), sha("2"))],
    random_rows(17, ["a"]), random_rows(300, ["a", "b", None, "é", ""]), random_rows(90, [f"s{i}" for i in range(40)]),
    [(7, "a", sha("same"), sha("other"))] * 40 + random_rows(20, ["a", "b"]),
])
@pytest.mark.parametrize("block_levels", [1, 3])
def test_manifest_equals_plain_tree(spark, monkeypatch, rows, block_levels):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(manifest, "BLOCK", 16 ** block_levels)
    assert proofs(made(spark, rows)) == plain_manifest(rows)


def test_some_leaves_only(spark):
    """Sparse proofs fetch siblings of every level, leaves included, and give the same values."""
    rows = random_rows(600, ["a", "b", None], seed=3)
    m = made(spark, rows)
    want = [r for r in plain_manifest(rows) if r[0] is not None and r[0] % 7 == 0]
    assert want and proofs(m, F.col("id") % 7 == 0) == want


def test_octopus_is_least():
    n, rng = 700, random.Random(2)
    for _ in range(20):
        places = sorted(rng.sample(range(n), rng.randint(1, 60)))
        need = manifest.missing_nodes(places, n)
        assert len(need) == len(set(need))
        below = lambda level, p: set(range(p * 16 ** level, min(n, (p + 1) * 16 ** level)))
        held = [set(places)] + [below(level, p) for level, p in need]
        # together they are the whole tree, and none is given by the others
        assert set().union(*held) == set(range(n)) and sum(map(len, held[1:])) + len(places) == n


def test_row_hash_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "é", 5, "n"), (None, "s", "", None, None)], "doc_id bigint, source string, text string, n_chars bigint, tree string")
    got = [r[0] for r in df.select(manifest.row_hash([F.col(c) for c in ("doc_id", "source", "n_chars", "text")])).collect()]
    assert got == [sha("1:1-1:52:é"), sha("-1:s-0:")]
    rows = spark.createDataFrame([(1, "a", sha("1"), None, "t")], SCHEMA + ", tree string")
    assert manifest.build_manifest(rows, ["claim"]).root == sha("1")


def test_places(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abbbbbbb"), rng.choice([None, 1, 2, 3]), rng.randint(0, 4)) for _ in range(500)]
    df = numbered_copies(spark.createDataFrame(rows, "g string, k int, w int").repartition(4), ["g", "k", "w"])
    for weight in (None, "w"):
        got = sorted(place_in_groups(df, ["g"], ["k", "w", "copy"], "places", weight).collect(), key=lambda r: (r.g, r.k or 0, r.w, r.copy))
        assert len(got) == len(rows)
        at = {}
        for r in got:
            assert r.place == at.get(r.g, 0)
            at[r.g] = at.get(r.g, 0) + (1 if weight is None else r.w)
    assert place_in_groups(df.limit(0), [], ["k"], "places").collect() == []
