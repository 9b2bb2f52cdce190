"""Documents without an id or with a repeated one: none is lost or mixed with another."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tokenweave.plans.catalog import QUERIES
from tokenweave.streaming.pack_stream import pack_batch


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    rows = [(i, text(300 * i)) for i in range(1, 9)]
    rows += [(5, text(90_000)), (5, text(100_000)), (5, "short"), (None, text(95_000)), (None, text(110_000)), (None, None)]
    sf = tmp_path_factory.mktemp("unkeyed")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(sf / "documents.parquet"))
    return str(sf), rows


@pytest.mark.parametrize("name", ["shards_roundtrip", "bpe_shards_roundtrip"])
def test_every_document_is_read_back(spark, corpus, name):
    sf, rows = corpus
    want = [(str(i), len((t or "").encode()), hashlib.md5((t or "").encode()).hexdigest()) for i, t in rows]
    assert sorted((str(r.doc_id), r.n_bytes, r.md5) for r in QUERIES[name](spark, sf).collect()) == sorted(want)


def test_stream_packs_null_ids_last_as_the_batch_packer(spark, corpus):
    sf, rows = corpus
    got, want = ([str(tuple(r)) for r in QUERIES[q](spark, sf).collect()] for q in ("stream_pack", "shard_segments"))
    assert sorted(got) == sorted(want)
    assert sum(r.src == 0 for r in QUERIES["shard_segments"](spark, sf).collect()) == len(rows)


def test_nothing_follows_null_keys(spark, tmp_path):
    batch = spark.createDataFrame([(7, "a"), (None, "b")], "doc_id bigint, text string")
    sink = str(tmp_path / "sink")
    pack_batch(batch, 0, sink, 100, closing=True)
    with pytest.raises(ValueError, match="packed already"):
        pack_batch(batch.where(F.col("doc_id") == 7), 1, sink, 100)
