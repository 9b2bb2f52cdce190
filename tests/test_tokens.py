import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tokenweave.operators import tokens
from tokenweave.sources.corpus import read_corpus, table_path


@pytest.fixture(scope="module")
def docs(spark):
    return read_corpus(spark, table_path(SF001, "documents"))


def test_words_encode_matches_python(spark, docs):
    V = 500
    vocab = tokens.word_vocab(docs, V)
    words = [r.word for r in vocab.orderBy("token_id").collect()]
    index = {w: i for i, w in enumerate(words)}
    enc = {r.doc_id: (r.n, list(r.ids)) for r in tokens.encode_words(docs, vocab, V).collect()}
    import re
    for r in docs.collect():
        ws = re.findall(r"[^ \t\r\n]+", r.text)
        want = [V - 1] + [index.get(w, V - 2) for w in ws]
        assert enc[r.doc_id] == (len(want), want)


def test_vocab_order_and_ties(spark):
    df = spark.createDataFrame([(0, "b a c a b d")], "doc_id bigint, text string")
    rows = tokens.word_vocab(df, 5).orderBy("token_id").collect()
    assert [(r.word, r.cnt) for r in rows] == [("a", 2), ("b", 2), ("c", 1)]


def test_bytes_round_trip(spark, docs):
    enc = tokens.encode_bytes(docs)
    got = {r.doc_id: r.md5 for r in enc.select("doc_id", F.md5(tokens.decode_bytes("ids")).alias("md5")).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == hashlib.md5(r.text.encode("utf-8")).hexdigest()
    first = enc.orderBy("doc_id").first()
    assert first.ids[0] == tokens.BYTE_EOT and first.n == len(first.ids)


def test_empty_and_null_text(spark):
    df = spark.createDataFrame([(0, ""), (1, None), (2, "héllo wörld")], "doc_id bigint, text string")
    df = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    enc = {r.doc_id: list(r.ids) for r in tokens.encode_bytes(df).collect()}
    assert enc[0] == [256] and enc[1] == [256]
    assert enc[2][1:] == list("héllo wörld".encode("utf-8"))


def test_word_tokens_lose_nothing(spark):
    """Words outside the vocabulary and any white space come back from bytes; single spaces between known words cost nothing."""
    texts = ["the cat sat on the mat", "the  cat", " the", "the ", "zzz", "the zzz cat", "the\tcat\nsat", "é😀 the é", "", "  ", "\n", "the\x0bcat",
             "the\u00a0cat the", "cat" * 40, "the cat", "the", " "]
    docs = spark.createDataFrame([*enumerate(texts), (None, "the cat"), (99, None)], "doc_id bigint, text string").coalesce(1)
    words = ["the", "cat", "sat", "on"]
    vocab = spark.createDataFrame([(i, w, 1) for i, w in enumerate(words)], "token_id int, word string, cnt bigint")
    enc = tokens.encode_words_lossless(docs, vocab, 10)
    got = {r.doc_id: (r.n, list(r.ids)) for r in enc.collect()}
    assert got[0] == (1 + 5 + 4, [9, 0, 1, 2, 3, 0, *(10 + b for b in b" mat")]) and got[None][1] == [9, 0, 1] and got[99][1] == [9]
    back = {r.doc_id: bytes(r.text).decode() for r in tokens.decode_words(enc, words, 10).collect()}
    assert back == {**dict(enumerate(texts)), None: "the cat", 99: ""}
    with pytest.raises(ValueError):
        tokens.encode_words_lossless(docs, vocab, 65_400)


def test_range_assert_fails_job(spark):
    bad = spark.createDataFrame([(0, [1, 70000])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception):
        tokens.assert_token_range(bad).collect()
    rep = tokens.token_range_report(bad).first()
    assert rep.n_out_of_range == 1 and rep.max_id == 70000


def test_byte_mode_pipeline_and_vocab(spark, docs):
    from tokenweave.operators import packing
    from tokenweave.plans.run import byte_offsets

    vocab = {r.token_id: r.token_hex for r in tokens.byte_vocab(spark).collect()}
    assert len(vocab) == 257 and vocab[65] == "41" and vocab[256] == ""
    seg = packing.cut_segments(byte_offsets(docs), 100_000)
    total = sum(len(r.text.encode("utf-8")) + 1 for r in docs.collect())
    man = packing.shard_manifest(seg).collect()
    assert sum(r.n_tokens for r in man) == total
    assert {r.split for r in man} == ({"val", "train"} if total > 100_000 else {"val"})
