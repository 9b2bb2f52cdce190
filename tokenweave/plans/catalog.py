"""Registered queries: one function per operator key of the survey.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns are scalars (tokens are summarised by sums and position-weighted
digests) so results can be compared row by row with the SQL oracle.  Queries
of the chain take the run's parameters too and are registered twice: over
byte tokens, and as ``bpe_...`` over byte pairs of the given rank table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenweave.operators import batching, bpe, evaluate, merges, packed, packing, sampling, tokens
from tokenweave.operators.prefix import ordered_offsets
from tokenweave.params import RANKED
from tokenweave.plans.run import DEFAULT_PARAMS, get_run
from tokenweave.session import hadoop_path
from tokenweave.sources import metrics as metrics_io
from tokenweave.sources import shards as shard_io
from tokenweave.sources.corpus import corpus_scan as _corpus_scan
from tokenweave.sources.corpus import read_corpus, read_table, table_path

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- M1: minimum slice

def q_corpus_scan(spark, sf):
    return _corpus_scan(spark, sf)


def q_corpus_split_scan(spark, sf):
    """The split choice at the source; the filter reaches the parquet scan."""
    return _corpus_scan(spark, sf, where="lang = 'en'")


def q_doc_token_lengths(spark, sf):
    return tokens.word_token_lengths(get_run(spark, sf).docs)


def q_doc_offsets(spark, sf):
    return get_run(spark, sf).doc_offsets


def q_unkeyed_offsets(spark, sf):
    """The corpus as if it had no key: places and offsets in the order of files and rows."""
    docs = read_corpus(spark, table_path(sf, "documents"), key=None)
    n = (F.octet_length("text") + 1).cast("bigint").alias("n")
    return ordered_offsets(docs.select("doc_id", n), ["doc_id"])


def q_shard_segments(spark, sf):
    run = get_run(spark, sf)
    seg = run.segments().withColumn("shard_index", F.col("shard_index").cast("bigint"))
    return packed.digests(seg, {"id_sum": ("data", "sum")}).select(
        "split", "shard_index", "pos", "doc_id", "src", "n", "doc_n", "id_sum",
        F.col("first_id").cast("bigint").alias("first_id"), F.col("last_id").cast("bigint").alias("last_id"))


def q_shard_manifest(spark, sf, p=DEFAULT_PARAMS):
    run = get_run(spark, sf, p)
    return packing.shard_manifest(run.layout, run.p.shard_prefix)


# ---------------------------------------------------------------- M2: token values, sink, discovery

def q_word_vocab(spark, sf):
    return get_run(spark, sf).vocab


def q_byte_token_lengths(spark, sf):
    return tokens.byte_token_lengths(get_run(spark, sf).docs)


def q_token_range_check(spark, sf):
    run = get_run(spark, sf)
    return tokens.token_range_report(tokens.assert_token_range(tokens.encode_bytes(run.docs)))


def q_shard_token_checksum(spark, sf):
    return packing.shard_token_checksum(get_run(spark, sf).segments())


def q_list_shards(spark, sf):
    run = get_run(spark, sf)
    return shard_io.list_shards(spark, run.shards_path, prefix=run.p.shard_prefix)


def q_load_shard_tokens(spark, sf):
    run = get_run(spark, sf)
    seg = shard_io.load_shard_tokens(spark, run.shards_path)
    total = F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, v: a + v)
    return seg.select("split", "shard_index", "pos", "doc_id", "n", total.alias("id_sum"), F.element_at("ids", -1).alias("last_id"))


# ---------------------------------------------------------------- M3: batching

def q_batch_schedule(spark, sf):
    return get_run(spark, sf).schedule()


def q_batches(spark, sf, p=DEFAULT_PARAMS):
    return packed.digests(get_run(spark, sf, p).batches(), {
        "x_sum": ("x", "sum"), "y_sum": ("y", "sum"), "x_wsum": ("x", "wsum"), "y_wsum": ("y", "wsum")})


def q_batch_rows(spark, sf):
    run = get_run(spark, sf)
    r = batching.batch_rows(run.batches(), run.p.B, run.p.T)
    return packed.digests(r, {"x_sum": ("x", "sum"), "y_wsum": ("y", "wsum")}).select(
        "split", "rank", "batch_no", F.col("row").cast("bigint").alias("row"), "x_sum", "y_wsum")


def q_next_token_pairs(spark, sf, p=DEFAULT_PARAMS):
    run = get_run(spark, sf, p)
    return batching.pair_counts(batching.planned_slots(run.slots(), run.schedule()), "split")


def q_val_batches(spark, sf):
    run = get_run(spark, sf)
    b = batching.planned_slots(run.slots("val"), run.val_plan, "rank", "batch_no", "epoch")
    x, y = packed.take(F.col("buf"), 0, run.p.BT), packed.take(F.col("buf"), 1, run.p.BT)
    return packed.digests(b.select("rank", "batch_no", "epoch", "shard_index", "slot", x.alias("x"), y.alias("y")),
                          {"x_sum": ("x", "sum"), "y_wsum": ("y", "wsum")})


def q_locate_batches(spark, sf):
    """Where the batches of three epochs are read, each found on its own."""
    run = get_run(spark, sf)
    per = batching.epoch_totals(run.schedule())
    wanted = per.select("split", "rank", F.explode(F.sequence(F.lit(0).cast("bigint"), 3 * F.col("per_epoch") - 1)).alias("batch_no"))
    return batching.locate_batches(wanted, run.lengths, run.p.BT, run.p.ranks)


def q_accumulation_plan(spark, sf):
    return get_run(spark, sf).train_plan


def q_epoch_wrap(spark, sf):
    run = get_run(spark, sf)
    per = batching.epoch_totals(run.schedule("train"))
    plan = run.train_plan.groupBy("split", "rank").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_planned"),
        (F.max("epoch") + 1).cast("bigint").alias("n_epochs"))
    return plan.join(per, ["split", "rank"])


def q_dropped_tail(spark, sf):
    run = get_run(spark, sf)
    return batching.dropped_tail(run.lengths, run.p.BT, run.p.ranks)


def q_tokens_per_step(spark, sf):
    run = get_run(spark, sf)
    return batching.tokens_per_step(run.train_plan, run.p.BT)


# ---------------------------------------------------------------- M4: evaluation

def q_ngram_model(spark, sf, p=DEFAULT_PARAMS):
    run = get_run(spark, sf, p)
    big, ctx, uni, N = run.model_tables
    m = evaluate.ngram_model(big, ctx, uni, N, run.p.vocab_size)
    return m.select("x", "y", "cnt", F.round("p", 9).alias("p"))


def _scored_val(run):
    big, ctx, uni, N = run.model_tables
    return evaluate.score(run.val_pairs, big, ctx, uni, N, run.p.vocab_size, bounded=True)


def q_cross_entropy(spark, sf, p=DEFAULT_PARAMS):
    s = _scored_val(get_run(spark, sf, p))
    return s.agg(F.round(F.sum(F.col("nll") * F.col("cnt")) / F.sum("cnt"), 4).alias("loss"),
                 F.sum("cnt").cast("bigint").alias("n_tokens"))


def q_val_loss_by_rank(spark, sf, p=DEFAULT_PARAMS):
    _, per_rank, _ = evaluate.val_losses(_scored_val(get_run(spark, sf, p)))
    return per_rank.select("rank", F.round("loss", 4).alias("loss"))


def q_val_loss(spark, sf, p=DEFAULT_PARAMS):
    _, _, overall = evaluate.val_losses(_scored_val(get_run(spark, sf, p)))
    return overall.select(F.round("loss", 4).alias("loss"))


def _train_loss_by_step(run):
    big, ctx, uni, N = run.model_tables
    pairs, per = run.train_pairs_by_step, run.steps_per_block
    scored = evaluate.score(evaluate.block_pairs(pairs, per), big, ctx, uni, N, run.p.vocab_size)
    return evaluate.mean_loss(evaluate.scored_steps(pairs, scored, per), ["step"])


def q_train_loss_by_step(spark, sf, p=DEFAULT_PARAMS):
    return _train_loss_by_step(get_run(spark, sf, p)).select("step", F.round("loss", 4).alias("loss"))


def q_train_loss_online(spark, sf, p=DEFAULT_PARAMS):
    run = get_run(spark, sf, p)
    loss = evaluate.online_step_loss(run.train_pairs_by_step, run.p.vocab_size, run.steps_per_block)
    return loss.select("step", F.round("loss", 4).alias("loss"))


def q_val_curve(spark, sf, p=DEFAULT_PARAMS):
    return get_run(spark, sf, p).curve.select("step", "split", F.round("loss", 4).alias("loss"))


def _steps(run):
    return run.train_plan.select("step").distinct()


def q_eval_schedule(spark, sf):
    run = get_run(spark, sf)
    return evaluate.eval_schedule(_steps(run), run.p.eval_every, run.p.checkpoint_every,
                                  run.max_steps - 1)


def q_lr_schedule(spark, sf):
    run = get_run(spark, sf)
    warmup = max(1, run.max_steps // 10)
    lr = evaluate.lr_schedule(_steps(run), warmup, run.max_steps)
    return lr.select("step", F.round("lr", 9).alias("lr"))


def q_metrics_log_lines(spark, sf):
    return metrics_io.metrics_lines(get_run(spark, sf).curve)


def q_parse_metrics_log(spark, sf):
    run = get_run(spark, sf)
    lines = metrics_io.metrics_lines(run.curve)
    path = shard_io.scratch_path(spark, "metrics")
    first = lines.filter(F.col("step") == 0)
    metrics_io.write_metrics(first, path, truncate=True)
    metrics_io.write_metrics(lines.filter(F.col("step") > 0), path, truncate=False)
    return metrics_io.parse_metrics(spark, path)


def q_step_report(spark, sf):
    run = get_run(spark, sf)
    return metrics_io.step_report(_train_loss_by_step(run).join(batching.tokens_per_step(run.train_plan, run.p.BT), "step"))


def q_segment_group_totals(spark, sf):
    return packing.segment_group_totals(get_run(spark, sf).layout)


def q_global_norm_clip(spark, sf):
    emb = read_table(spark, sf, "embeddings", key="vec_id").select("vec_id", "embedding")
    clipped, norm = evaluate.global_norm_clip(emb, "embedding", 1.0)
    sq = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v)
    return clipped.select("vec_id", F.round(F.lit(norm), 6).alias("global_norm"),
                          F.round(F.sqrt(sq), 6).alias("clipped_norm"))


# ---------------------------------------------------------------- M5: sampling

def _emb_probs(spark, sf):
    emb = read_table(spark, sf, "embeddings", key="vec_id").select("vec_id", "embedding")
    d = sampling.softmax_rows(emb, "embedding", "probs")
    # outer generator: no inferred filter that would evaluate the arrays twice
    d = d.select("vec_id", F.posexplode_outer("probs").alias("idx", "p")).filter(F.col("idx").isNotNull())
    return d.withColumn("idx", F.col("idx").cast("bigint"))


def q_softmax(spark, sf):
    return _emb_probs(spark, sf).select("vec_id", "idx", F.round("p", 6).alias("p"))


def q_topk_per_group(spark, sf):
    run = get_run(spark, sf)
    t = sampling.topk(_emb_probs(spark, sf), ["vec_id"], "p", run.p.top_k, "idx")
    return t.select("vec_id", "idx", F.round("p", 6).alias("p"),
                    F.col("rank_in_group").cast("bigint").alias("rank_in_group"))


def q_weighted_sample(spark, sf):
    run = get_run(spark, sf)
    t = sampling.topk(_emb_probs(spark, sf), ["vec_id"], "p", run.p.top_k, "idx")
    return sampling.weighted_draw(t, ["vec_id"], "idx", "p", run.p.seed)


def q_encode_prompts(spark, sf, p=DEFAULT_PARAMS):
    return packed.digests(get_run(spark, sf, p).prompts, {"id_sum": ("data", "sum"), "id_wsum": ("data", "wsum")})


def _generated(spark, sf, p):
    """Every sequence and its bytes (T5)."""
    run = get_run(spark, sf, p)
    both = packed.pack(run.generated.withColumn("tokens", F.array_join("ids", " ")), data="bytes")
    return packed.decode(both, run.token_table, "bytes")


def q_generate(spark, sf, p=DEFAULT_PARAMS):
    """Prompt and continuation of every sequence: its ids, and their bytes in hex."""
    return _generated(spark, sf, p).select("item_id", "seq", F.size(F.split("tokens", " ")).cast("bigint").alias("n"), "tokens",
                                           F.hex("bytes").alias("bytes_hex"))


def q_generate_text(spark, sf, p=DEFAULT_PARAMS):
    """T5 on generated sequences: their text; bytes that are no UTF-8 become replacement characters."""
    return _generated(spark, sf, p).select("item_id", "seq", F.call_function("make_valid_utf8", F.col("bytes").cast("string")).alias("text"))


def q_doc_tokens(spark, sf, p=DEFAULT_PARAMS):
    """The tokens of every document."""
    return packed.digests(get_run(spark, sf, p).doc_tokens, {"id_sum": ("data", "sum"), "id_wsum": ("data", "wsum")})


def q_shards_roundtrip(spark, sf, p=DEFAULT_PARAMS):
    """Every document read back from the written shards: its pieces in order, decoded to bytes.

    A document is known by its place in the token stream, as ids can be null or repeated.
    """
    run = get_run(spark, sf, p)
    off = F.col("shard_index").cast("bigint") * run.p.shard_size + F.col("pos") - F.col("src")
    pieces = run.segments().groupBy("doc_id", off.alias("off")).agg(packed.joined("data", "src").alias("data"))
    text = packed.decode(pieces, run.token_table)
    return text.select("doc_id", F.octet_length("data").cast("bigint").alias("n_bytes"), F.md5("data").alias("md5"))


def q_decode_roundtrip(spark, sf):
    run = get_run(spark, sf)
    enc = tokens.encode_bytes(run.docs)
    return enc.select("doc_id", F.md5(tokens.decode_bytes("ids")).alias("md5"))


def q_decode_words_roundtrip(spark, sf):
    """T5 words mode: every document decoded from its word and byte tokens."""
    run = get_run(spark, sf)
    text = tokens.decode_words(run.word_tokens, run.vocab_words, run.p.word_vocab_size)
    return text.select("doc_id", F.md5("text").alias("md5"))


def q_learn_bpe_merges(spark, sf):
    return get_run(spark, sf).bpe_merges


def q_learn_bpe_vocabulary(spark, sf):
    """A vocabulary of thousands of merges, each the most frequent pair of its turn."""
    run = get_run(spark, sf)
    return merges.learn_merges(run.docs, run.p.vocabulary_merges)


def q_bpe_encode(spark, sf):
    """BPE encode: token counts and id sums, and the md5 of the decoded text."""
    run = get_run(spark, sf)
    enc = packed.digests(packed.pack(run.bpe_tokens).withColumn("text", F.col("data")), {"id_sum": ("data", "sum")})
    return packed.decode(enc, bpe.token_bytes(run.bpe_table), "text").select("doc_id", F.md5("text").alias("md5"), "n", "id_sum")


def q_stream_pack(spark, sf):
    """The corpus arrives as files in doc_id order and is packed incrementally.

    ``stream_files`` arrivals, each a range of doc_ids between observed
    quantiles and written by one job of many tasks, are packed one after the
    other by a stream that is started again for each, as it is in use.
    Documents without a doc_id are one more arrival, the last.  The
    packed segments must equal the batch packer's, so the oracle is the same
    as ``shard_segments``.
    """
    from tokenweave.streaming.pack_stream import pack_stream
    run = get_run(spark, sf)
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").cast("bigint"), "text")
    parts = run.p.stream_files
    cuts = sorted(set(docs.select(F.col("doc_id").cast("double").alias("k")).approxQuantile("k", [i / parts for i in range(1, parts)], 0.01)))
    arrival = F.lit(0)
    for cut in cuts:
        arrival = arrival + F.when(F.col("doc_id").cast("double") > cut, 1).otherwise(0)
    last = len(cuts) + 1  # null keys
    staged, src, sink = (shard_io.scratch_path(spark, f"stream-{w}") for w in ("staged", "src", "sink"))
    docs.withColumn("arrival", F.when(F.col("doc_id").isNull(), last).otherwise(arrival)).write.partitionBy("arrival").parquet(staged)
    fs, at = hadoop_path(spark, src)
    fs.mkdirs(at)
    for i in range(last + 1):
        here, there = (hadoop_path(spark, f"{d}/arrival={i}")[1] for d in (staged, src))
        if fs.exists(here):
            fs.rename(here, there)  # the files arrive
        elif i == last:
            break
        pack_stream(spark, src, sink, run.p.shard_size, closing=i == last)
    seg = spark.read.parquet(f"{sink}/segments")
    return packed.digests(seg, {"id_sum": ("data", "sum")}).select(
        "split", "shard_index", "pos", "doc_id", "src", "n", "doc_n", "id_sum",
        F.col("first_id").cast("bigint").alias("first_id"), F.col("last_id").cast("bigint").alias("last_id"))


def _ranked(query: Callable) -> Query:
    def run(spark, sf):
        return query(spark, sf, RANKED)
    run.__name__ = f"bpe_{query.__name__.removeprefix('q_')}"
    run.__doc__ = query.__doc__
    return run


QUERIES: dict[str, Query] = {
    "corpus_scan": q_corpus_scan,
    "corpus_split_scan": q_corpus_split_scan,
    "doc_token_lengths": q_doc_token_lengths,
    "doc_offsets": q_doc_offsets,
    "unkeyed_offsets": q_unkeyed_offsets,
    "shard_segments": q_shard_segments,
    "shard_manifest": q_shard_manifest,
    "word_vocab": q_word_vocab,
    "byte_token_lengths": q_byte_token_lengths,
    "token_range_check": q_token_range_check,
    "shard_token_checksum": q_shard_token_checksum,
    "list_shards": q_list_shards,
    "load_shard_tokens": q_load_shard_tokens,
    "batch_schedule": q_batch_schedule,
    "batches": q_batches,
    "locate_batches": q_locate_batches,
    "batch_rows": q_batch_rows,
    "next_token_pairs": q_next_token_pairs,
    "val_batches": q_val_batches,
    "accumulation_plan": q_accumulation_plan,
    "epoch_wrap": q_epoch_wrap,
    "dropped_tail": q_dropped_tail,
    "tokens_per_step": q_tokens_per_step,
    "ngram_model": q_ngram_model,
    "cross_entropy": q_cross_entropy,
    "val_loss_by_rank": q_val_loss_by_rank,
    "val_loss": q_val_loss,
    "train_loss_by_step": q_train_loss_by_step,
    "train_loss_online": q_train_loss_online,
    "val_curve": q_val_curve,
    "eval_schedule": q_eval_schedule,
    "lr_schedule": q_lr_schedule,
    "metrics_log_lines": q_metrics_log_lines,
    "parse_metrics_log": q_parse_metrics_log,
    "step_report": q_step_report,
    "segment_group_totals": q_segment_group_totals,
    "global_norm_clip": q_global_norm_clip,
    "softmax": q_softmax,
    "topk_per_group": q_topk_per_group,
    "weighted_sample": q_weighted_sample,
    "encode_prompts": q_encode_prompts,
    "generate": q_generate,
    "generate_text": q_generate_text,
    "shards_roundtrip": q_shards_roundtrip,
    "doc_tokens": q_doc_tokens,
    "decode_roundtrip": q_decode_roundtrip,
    "decode_words_roundtrip": q_decode_words_roundtrip,
    "learn_bpe_merges": q_learn_bpe_merges,
    "learn_bpe_vocabulary": q_learn_bpe_vocabulary,
    "bpe_encode": q_bpe_encode,
    "stream_pack": q_stream_pack,
}

# The chain once more on byte pairs.
QUERIES |= {f"bpe_{q.__name__.removeprefix('q_')}": _ranked(q) for q in (
    q_doc_tokens, q_shard_manifest, q_shards_roundtrip, q_batches, q_next_token_pairs, q_ngram_model, q_cross_entropy,
    q_val_loss_by_rank, q_val_loss, q_train_loss_by_step, q_train_loss_online, q_val_curve, q_encode_prompts, q_generate, q_generate_text)}
