import random

import pytest
from pyspark.sql import functions as F

from conftest import exchange_inputs, lengths_frame
from seqref import fold_pieces
from tokenweave.operators import packing
from tokenweave.operators.prefix import ordered_offsets, scan_parts


def spark_pieces(spark, lengths, S, fan=2):
    offs = ordered_offsets(lengths_frame(spark, lengths), ["doc_id"], fan=fan)
    seg = packing.cut_segments(offs, S)
    rows = seg.select("shard_index", "pos", "doc_id", "src", "n").collect()
    return sorted(tuple(int(v) for v in r) for r in rows)


# FIXTURES.md section 4: (S, lengths, expected pieces as (shard, n) in order)
EDGE_CASES = [
    ("fits", 10, [3, 4], [(0, 3), (0, 4)]),
    ("exactly full", 10, [4, 6, 2], [(0, 4), (0, 6), (1, 2)]),
    ("exactly full at the end", 10, [4, 6], [(0, 4), (0, 6)]),
    ("cut once", 10, [7, 8], [(0, 7), (0, 3), (1, 5)]),
    ("longer than a shard", 10, [4, 25], [(0, 4), (0, 6), (1, 10), (2, 9)]),
    ("first document fills", 10, [12], [(0, 10), (1, 2)]),
    ("empty text", 10, [1], [(0, 1)]),
]


@pytest.mark.parametrize("name,S,lengths,expect", EDGE_CASES, ids=[c[0] for c in EDGE_CASES])
def test_edge_cases(spark, name, S, lengths, expect):
    got = spark_pieces(spark, lengths, S)
    assert [(s, n) for s, _, _, _, n in got] == expect
    assert got == sorted(fold_pieces(lengths, S))


def test_closed_form_matches_fold_random(spark):
    rng = random.Random(7)
    cases = []
    for _ in range(12):
        S = rng.randint(3, 30)
        lengths = [rng.choice([1, 1, 2, rng.randint(1, 3 * S)]) for _ in range(rng.randint(1, 25))]
        cases.append((S, lengths))
    for S, lengths in cases:
        assert spark_pieces(spark, lengths, S) == sorted(fold_pieces(lengths, S)), (S, lengths)


def test_conservation_and_coverage(spark):
    lengths = [random.Random(3).randint(1, 50) for _ in range(200)]
    S = 37
    pieces = spark_pieces(spark, lengths, S)
    assert sum(p[4] for p in pieces) == sum(lengths)
    covered = sorted((s * S + pos + k) for s, pos, _, _, n in pieces for k in range(n))
    assert covered == list(range(sum(lengths)))


def test_offsets_are_running_sum(spark):
    lengths = [5, 1, 9, 2, 2, 7, 1, 1, 30, 4]
    offs = ordered_offsets(lengths_frame(spark, lengths), ["doc_id"], fan=2).orderBy("doc_id")
    got = [r["off"] for r in offs.collect()]
    want = [sum(lengths[:i]) for i in range(len(lengths))]
    assert got == want


def test_split_labels_and_manifest(spark):
    offs = ordered_offsets(lengths_frame(spark, [7, 8, 12]), ["doc_id"])
    man = packing.shard_manifest(packing.cut_segments(offs, 10)).orderBy("shard_index").collect()
    assert [(r.split, r.shard_index, r.n_tokens) for r in man] == [
        ("val", 0, 10), ("train", 1, 10), ("train", 2, 7)]
    assert man[0].label == "corpus_val_000000" and man[2].label == "corpus_train_000002"


def test_no_single_partition_exchange_over_documents(spark):
    """The running sum must not move every document to one task."""
    offs = ordered_offsets(lengths_frame(spark, list(range(1, 500))), ["doc_id"], fan=4)
    single = [inp for args, inp in exchange_inputs(offs) if "SinglePartition" in args]
    # the only single-partition exchange carries totals of groups of parts
    assert all("doc_id" not in inp for inp in single)


@pytest.mark.parametrize("parts,fan", [(0, 4), (1, 4), (4, 4), (5, 4), (70, 4), (300, 7)])
def test_tree_scan_of_any_depth(spark, parts, fan):
    """Levels above the leaves: as many as the number of parts asks for."""
    rng = random.Random(parts)
    rows = [(i, rng.randint(0, 9)) for i in range(parts)]
    got = {r.part: r.base for r in scan_parts(spark.createDataFrame(rows, "part bigint, total bigint"), fan).collect()}
    assert got == {i: sum(t for _, t in rows[:i]) for i, _ in rows}


@pytest.mark.parametrize("ids", [
    list(range(3000)) + [1 << 50],  # an outlier
    [(i * 2654435761 + 12345) % (1 << 61) - (1 << 60) for i in range(3000)],  # hashed
    [7] * 1000 + list(range(0, 28_000, 14)),  # a third of the rows share a key
    [None] * 1000 + list(range(2000)),  # or have none
])
def test_offsets_for_any_key(spark, ids):
    rng = random.Random(5)
    rows = [(k, rng.randint(1, 9), bytearray(rng.randbytes(6))) for k in ids]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, n bigint, data binary").repartition(4)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # so few rows would be one part
    try:
        offs = ordered_offsets(df, [F.col("doc_id").asc_nulls_last(), "n", F.xxhash64("data")], fan=3)
    finally:
        spark.conf.unset(coalesce)
    # no part holds much more than its share, whatever key the rows have
    parts = [r["count"] for r in leaves_of(offs).groupBy("part").count().collect()]
    assert len(parts) >= 6 and max(parts) <= 2.5 * len(rows) / 8
    out = sorted(offs.collect(), key=lambda r: r.off)
    assert len(out) == len(rows)
    at = 0
    for r in out:  # no hole, no overlap
        assert r.off == at
        at += r.n
    keys = [r.doc_id for r in out]
    assert keys == sorted(keys, key=lambda k: (k is None, k or 0))


def leaves_of(offs):
    """The written leaves that offsets were made from."""
    path = next(p for p in offs.inputFiles() if "/ordered-" in p).rsplit("/", 1)[0]
    return offs.sparkSession.read.parquet(path)
