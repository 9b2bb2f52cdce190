"""A run over one corpus: the derived tables every query builds on.

``CorpusRun`` holds the plans of one (session, input folder, parameters)
triple.  Derived tables that many queries reuse are materialised once:
shards are written as partitioned parquet under the shared checkpoint
folder (as the reference writes shard files), and the next-token table is
checkpointed before the generation loop.  Everything is built from the
``documents`` table, so the work grows with it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenweave.functions.common import idiv
from tokenweave.operators import batching, bpe, dictionary, evaluate, merges, packing, sampling, tokens
from tokenweave.operators.packed import pack, pack_text, unpack
from tokenweave.operators.prefix import ordered_offsets
from tokenweave.params import PackParams, rank_path
from tokenweave.session import cut_lineage, folder_state
from tokenweave.sources import shards as shard_io
from tokenweave.sources.corpus import read_corpus, read_table, table_path

DEFAULT_PARAMS = PackParams()
TOKENS_PER_GROUP = 3_000_000  # of neighbouring steps whose losses are worked out together
_RUNS: dict = {}


def byte_offsets(docs: DataFrame) -> DataFrame:
    """``(doc_id, data, n, off)``: byte tokens in stream order: key (null last), then length and content of the text.

    The texts are sorted and written; they become tokens where they are read, so no token is shuffled.
    """
    rows = docs.select("doc_id", "text", (F.octet_length("text") + 1).cast("bigint").alias("n"))
    placed = ordered_offsets(rows, [F.col("doc_id").asc_nulls_last(), "n", F.xxhash64("text")])
    return pack_text(placed, tokens.BYTE_EOT)


def get_run(spark: SparkSession, sf_dir: str, params: PackParams = DEFAULT_PARAMS) -> "CorpusRun":
    """The run over one folder; runs of stopped sessions are forgotten."""
    app = spark.sparkContext.applicationId
    for old in [k for k in _RUNS if k[0] != app]:
        del _RUNS[old]
    # a table that was written anew is another run
    key = (app, sf_dir.rstrip("/"), params, *(folder_state(spark, table_path(sf_dir, t)) for t in ("documents", "benchmark")))
    run = _RUNS.get(key)
    if run is None:
        run = _RUNS[key] = CorpusRun(spark, sf_dir, params)
    return run


def clear_runs(spark: SparkSession | None = None) -> None:
    """Forget all runs; with a session, delete the tables that they wrote."""
    _RUNS.clear()
    if spark is not None:
        shard_io.drop_scratch(spark)


class CorpusRun:
    def __init__(self, spark: SparkSession, sf_dir: str, params: PackParams = DEFAULT_PARAMS):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.p = params.validate()

    # ------------------------------------------------------------ tokens
    @cached_property
    def docs(self) -> DataFrame:
        return read_corpus(self.spark, table_path(self.sf_dir, "documents"))

    @cached_property
    def vocab(self) -> DataFrame:
        """T7, materialised once: at most V rows."""
        return cut_lineage(tokens.word_vocab(self.docs, self.p.word_vocab_size))

    @cached_property
    def vocab_words(self) -> list[str]:
        return tokens.vocab_list(self.vocab, self.p.word_vocab_size)

    @cached_property
    def prompts(self) -> DataFrame:
        """T4: the benchmark texts as prompts ``(item_id, n, data)``, whole and without end-of-text."""
        src = read_table(self.spark, self.sf_dir, "benchmark", key="item_id").select(
            F.col("item_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        if self.p.tokens == "ranks":
            enc = dictionary.encode_pieces(src, dictionary.piece_dictionary(src, self.token_table, dictionary.HOT_PIECES), None, table=self.token_table)
        else:
            enc = tokens.encode_bytes(src, eot=False)
        return shard_io.written(pack(enc).withColumnRenamed("doc_id", "item_id"), "prompts")

    @cached_property
    def word_tokens(self) -> DataFrame:
        """Words-mode tokens (T7): words of the vocabulary, bytes for everything else."""
        return tokens.encode_words_lossless(self.docs, self.vocab, self.p.word_vocab_size)

    @cached_property
    def token_table(self) -> list[bytes]:
        """The bytes of every id but end-of-text, which is one past the last."""
        if self.p.tokens == "ranks":
            return bpe.load_ranks(rank_path(self.p, self.spark))
        return [bytes([i]) for i in range(256)]

    @cached_property
    def pieces(self) -> DataFrame:
        """The frequent pieces of the corpus under the rank table."""
        return dictionary.piece_dictionary(self.docs, self.token_table, dictionary.HOT_PIECES)

    @cached_property
    def doc_tokens(self) -> DataFrame:
        """``(doc_id, n, data)``: the run's tokens, end-of-text first (byte pairs are written once)."""
        if self.p.tokens == "ranks":
            with shard_io.passing(self.spark, "piece-counts"):
                pieces = self.pieces
            return shard_io.written(pack(dictionary.encode_pieces(self.docs, pieces, len(self.token_table), table=self.token_table)), "tokens")
        n = (F.octet_length("text") + 1).cast("bigint")
        return pack_text(self.docs.select("doc_id", n.alias("n"), "text"), tokens.BYTE_EOT)

    def offsets(self) -> DataFrame:
        """The tokens of every document and how many come before them (written anew on each call)."""
        if self.p.tokens == "ranks":
            return ordered_offsets(self.doc_tokens, [F.col("doc_id").asc_nulls_last(), "n", F.xxhash64("data")])
        return byte_offsets(self.docs)

    @cached_property
    def doc_offsets(self) -> DataFrame:
        """P2 without tokens: ``(doc_id, n, off)`` from lengths that the JVM computes."""
        n = (F.octet_length("text") + 1).cast("bigint").alias("n")
        return ordered_offsets(self.docs.select("doc_id", n, F.xxhash64("text").alias("h")),
                               [F.col("doc_id").asc_nulls_last(), "n", "h"]).drop("h")

    @cached_property
    def layout(self) -> DataFrame:
        """Shard segments without tokens."""
        if self.p.tokens == "ranks":
            return shard_io.read_shards(self.spark, self.shards_path).drop("data")
        return packing.cut_segments(self.doc_offsets, self.p.shard_size)

    # ------------------------------------------------------------ shards on storage
    @cached_property
    def shards_path(self) -> str:
        path = shard_io.scratch_path(self.spark, "shards")
        with shard_io.passing(self.spark, "ordered", "parts"):
            return shard_io.write_shards(packing.cut_segments(self.offsets(), self.p.shard_size), path, self.p.shard_size, in_order=True)

    @cached_property
    def slots_path(self) -> str:
        """The shards cut at slot borders, written once for all batch queries."""
        path = shard_io.scratch_path(self.spark, "slots")
        return batching.write_slots(self.segments(), self.p.BT, path)

    def segments(self, split: str | None = None) -> DataFrame:
        return shard_io.read_shards(self.spark, self.shards_path, split)

    def slots(self, split: str | None = None) -> DataFrame:
        return shard_io.read_shards(self.spark, self.slots_path, split)

    @cached_property
    def lengths(self) -> DataFrame:
        """(split, shard_index, L) of the written shards (small: one row per shard)."""
        return cut_lineage(batching.shard_lengths(self.segments()))

    def schedule(self, split: str | None = None) -> DataFrame:
        """The batches of one split, or of both."""
        lengths = self.lengths if split is None else self.lengths.filter(F.col("split") == split)
        return batching.batch_schedule(lengths, self.p.BT, self.p.ranks)

    def batches(self) -> DataFrame:
        """Every batch of one epoch, of both splits."""
        return batching.batches(self.slots(), self.lengths, self.p.BT, self.p.ranks)

    # ------------------------------------------------------------ plans
    @cached_property
    def train_tokens(self) -> int:
        r = self.lengths.filter(F.col("split") == "train").agg(F.sum("L")).first()[0]
        return int(r or 0)

    @cached_property
    def max_steps(self) -> int:
        """Q8: optimizer steps in one pass over the train split."""
        return self.train_tokens // self.p.total_batch

    @cached_property
    def train_plan(self) -> DataFrame:
        if self.max_steps <= 0:
            raise ValueError("train split is smaller than one total batch")
        # one row per planned batch: small, reused by several queries and a size check
        return cut_lineage(batching.accumulation_plan(self.schedule("train"), self.max_steps,
                                                      self.p.accum_steps, self.p.ranks))

    @cached_property
    def val_plan(self) -> DataFrame:
        return cut_lineage(batching.val_plan(self.schedule("val"), self.p.val_batches, self.p.ranks))

    @cached_property
    def train_reads(self) -> DataFrame:
        """``(step, buf)``: the buffer of every planned train batch, found from its slot without the plan's rows."""
        if self.max_steps <= 0:
            raise ValueError("train split is smaller than one total batch")
        reads = batching.planned_reads(self.slots("train"), self.lengths.filter(F.col("split") == "train"),
                                       self.p.BT, self.p.ranks, self.max_steps * self.p.accum_steps)
        return reads.select(idiv(F.col("batch_no"), self.p.accum_steps).alias("step"), "buf")

    @cached_property
    def train_pairs_by_step(self) -> DataFrame:
        """(step, x, y, cnt): next-token pairs of every planned train batch, counted where they are read; never written."""
        return batching.pair_rows(self.train_reads, "step")

    @cached_property
    def train_pairs_by_interval(self) -> DataFrame:
        """The same with the first step of an evaluation interval in place of a step."""
        first = F.col("step") - F.col("step") % self.p.eval_every
        return batching.pair_rows(self.train_reads.select(first.alias("step"), "buf"), "step")

    @property
    def steps_per_block(self) -> int:
        """Steps whose pairs are scored together."""
        return max(1, TOKENS_PER_GROUP // self.p.total_batch)

    @cached_property
    def train_pairs(self) -> DataFrame:
        """(x, y, cnt) of the whole train plan, counted without the steps: far fewer rows than by step."""
        return batching.pair_counts(self.train_reads)

    @cached_property
    def val_pairs(self) -> DataFrame:
        """(rank, batch_no, x, y, cnt) of the first ``val_batches`` val batches."""
        planned = batching.planned_slots(self.slots("val"), self.val_plan, "rank", "batch_no")
        return cut_lineage(batching.pair_counts(planned, "rank", "batch_no"))

    @cached_property
    def model_tables(self):
        big = cut_lineage(evaluate.ngram_tables(self.train_pairs)[0])
        ctx = cut_lineage(big.groupBy("x").agg(F.sum("cxy").cast("bigint").alias("cx")))
        uni = cut_lineage(big.groupBy("y").agg(F.sum("cxy").cast("bigint").alias("cy")))
        N = int(uni.agg(F.coalesce(F.sum("cy"), F.lit(0))).first()[0])
        return big, ctx, uni, N

    @cached_property
    def next_table(self) -> DataFrame:
        """Top-k next tokens of every context (at most V * k rows), materialised once."""
        big, ctx, uni, N = self.model_tables
        V, k = self.p.vocab_size, self.p.top_k
        table = sampling.next_token_topk(big, ctx, uni, N, V, k)
        return cut_lineage(table.unionByName(sampling.unseen_context_rows(uni, N, V, k)))

    @cached_property
    def generated(self) -> DataFrame:
        """The continued prompts ``(item_id, seq, ids)``: ``num_sequences`` rows a prompt, each ``new_tokens`` longer."""
        prompts = unpack(self.prompts.drop("n"))
        return cut_lineage(sampling.generate(prompts, self.next_table, self.p.num_sequences, None, self.p.seed, new_tokens=self.p.new_tokens))

    @cached_property
    def curve(self) -> DataFrame:
        """E5, materialised: one row per evaluation."""
        return cut_lineage(evaluate.val_curve(self.train_pairs_by_interval, self.val_pairs, self.max_steps,
                                              self.p.eval_every, self.p.vocab_size))

    # ------------------------------------------------------------ byte-pair mode
    @cached_property
    def bpe_merges(self) -> DataFrame:
        return cut_lineage(merges.learn_merges(self.docs, self.p.bpe_merges))

    @cached_property
    def bpe_table(self) -> list:
        return bpe.merge_table(self.bpe_merges, self.p.bpe_merges)

    @cached_property
    def bpe_tokens(self) -> DataFrame:
        return bpe.encode_bpe(self.docs, self.bpe_merges, self.p.bpe_merges)
