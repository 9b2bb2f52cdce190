"""Skew: one document holds a third of the tokens and one word a third of the words."""

import random

from pyspark.sql import functions as F

from seqref import fold_pieces, loader_batches
from tokenweave.operators import batching, evaluate, packing, tokens
from tokenweave.operators.packed import pack, unpack
from tokenweave.operators.prefix import ordered_offsets


def skewed_corpus(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for d in range(120):
        n = rng.randint(5, 60)
        docs.append((d, " ".join("hot" if rng.random() < 0.33 else rng.choice(words) for _ in range(n))))
    total = sum(len(t.split()) for _, t in docs)
    docs[37] = (37, " ".join(["hot"] * (total // 2)))  # one document with about a third of all tokens
    return spark.createDataFrame(docs, "doc_id bigint, text string"), docs


def test_skewed_corpus_packs_and_batches_exactly(spark):
    df, docs = skewed_corpus(spark)
    V, S, B, T, P = 100, 512, 2, 8, 3
    BT = B * T
    vocab = tokens.word_vocab(df, V)
    assert vocab.orderBy("token_id").first().word == "hot"
    toks = tokens.encode_words(df, vocab, V)
    seg = packing.cut_segments(ordered_offsets(pack(toks), ["doc_id"], fan=3), S)

    lengths = [len(t.split()) + 1 for _, t in sorted(docs)]
    got = sorted((r.shard_index, r.pos, r.doc_id, r.src, r.n) for r in seg.collect())
    assert got == sorted(fold_pieces(lengths, S))

    # the hot document spans many shards; no segment is longer than a shard
    assert max(r.n for r in seg.collect()) <= S

    # batches: the regroup is keyed by slot, so every buffer is BT+1 tokens
    lens = batching.shard_lengths(seg)
    sched = batching.batch_schedule(lens, BT, P)
    slots = batching.slot_table(seg, BT)
    b = unpack(unpack(batching.batches(slots, lens, BT, P), "x", "x"), "y", "y")
    assert all(len(r.x) == BT and len(r.y) == BT for r in b.collect())
    stream = {}
    enc = {r.doc_id: list(r.ids) for r in toks.collect()}
    flat = [t for d in sorted(enc) for t in enc[d]]
    for r in b.select("rank", "batch_no", "shard_index", "slot", "x").collect():
        start = r.shard_index * S + r.slot * BT
        assert list(r.x) == flat[start:start + BT]
    shard_L = [row.L for row in lens.orderBy("shard_index").collect()]
    per_rank = {r.rank: r.c for r in sched.groupBy("rank").agg(F.count("*").alias("c")).collect()}
    for rank in range(P):
        want = loader_batches(shard_L, B, T, P, rank, per_rank.get(rank, 0))
        assert want is None or len(want) == per_rank[rank]

    # the hot pair is one row of the bigram table, its count is exact
    pc = batching.pair_counts(batching.planned_slots(slots, sched, "batch_no"), "batch_no")
    big, _, _, _ = evaluate.ngram_tables(pc)
    hot = vocab.filter("word = 'hot'").first().token_id
    row = big.filter((F.col("x") == hot) & (F.col("y") == hot)).collect()
    assert len(row) == 1
    want = sum(1 for r in b.collect() for a, c in zip(r.x, r.y) if a == hot and c == hot)
    assert row[0].cxy == want
