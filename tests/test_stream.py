"""Incremental packing equals the batch packer; a replayed batch changes nothing; a lost place stops it."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tokenweave.operators import packing
from tokenweave.plans.run import byte_offsets
from tokenweave.sources.corpus import read_corpus, table_path
from tokenweave.streaming.pack_stream import pack_batch, pack_stream

COLS = ["split", "shard_index", "pos", "doc_id", "src", "n", "doc_n"]
S = 20_000


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS, F.hex("data")).collect())


def _between(docs, a, b):
    return docs.filter((F.col("doc_id") >= a) & (F.col("doc_id") < b))


@pytest.fixture(scope="module")
def docs(spark):
    return read_corpus(spark, table_path(SF001, "documents"))


@pytest.fixture(scope="module")
def want(spark, docs):
    return _rows(packing.cut_segments(byte_offsets(docs), S))


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_path, docs, want):
    src, sink = tmp_path / "src", str(tmp_path / "sink")
    for i, (a, b) in enumerate([(0, 50), (50, 120), (120, 200)]):
        _between(docs, a, b).repartition(3).write.parquet(str(src / f"arrival={i:04d}"))  # many files an arrival
        streamed = pack_stream(spark, str(src), sink, S)
    assert streamed.select("batch_id").distinct().count() == 3
    assert _rows(streamed) == want
    # replay batch 1 (as after a failure): same carry in, same rows out
    pack_batch(_between(docs, 50, 120), 1, sink, S)
    assert _rows(spark.read.parquet(f"{sink}/segments")) == want


def test_files_per_trigger(spark, tmp_path, docs, want):
    src, sink = tmp_path / "src", str(tmp_path / "sink")
    for i, (a, b) in enumerate([(0, 50), (50, 120), (120, 200)]):
        _between(docs, a, b).coalesce(1).write.parquet(str(src / f"arrival={i:04d}"))
    streamed = pack_stream(spark, str(src), sink, S, files_per_trigger=2)
    assert streamed.select("batch_id").distinct().count() == 2
    assert _rows(streamed) == want


def test_unreadable_carry_raises(spark, tmp_path, docs):
    sink = str(tmp_path / "sink")
    pack_batch(_between(docs, 0, 20), 0, sink, S)
    with pytest.raises(Exception):
        pack_batch(_between(docs, 40, 60), 2, sink, S)  # batch 1 left no carry
    part = next((tmp_path / "sink" / "_carry" / "batch_id=0").glob("part-*.parquet"))
    part.write_bytes(b"damaged")
    with pytest.raises(Exception):
        pack_batch(_between(docs, 20, 40), 1, sink, S)


def test_order_is_checked(spark, tmp_path, docs):
    sink = str(tmp_path / "sink")
    pack_batch(_between(docs, 50, 60), 0, sink, S)
    with pytest.raises(ValueError, match="packed already"):
        pack_batch(_between(docs, 40, 55), 1, sink, S)
    with pytest.raises(ValueError, match="without a key"):
        pack_batch(docs.limit(1).withColumn("doc_id", F.lit(None).cast("bigint")), 1, sink, S)
    empty = docs.limit(0)
    pack_batch(empty, 1, sink, S)  # an empty batch carries the place on
    pack_batch(_between(docs, 60, 70), 2, sink, S)
    with pytest.raises(ValueError, match="packed already"):
        pack_batch(_between(docs, 65, 80), 3, sink, S)
