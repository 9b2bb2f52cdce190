"""Benchmark: run every registered query at $BENCH_SF_DIR and print one JSON line.

The suite runs as one pipeline, the way the reference is used: the corpus is
tokenised and packed into shards once (``pack_sec``), and every query then
reads what it needs from the written shards.  Each query is forced to
completion through the ``noop`` sink (no collect to the driver).  Further
measures: ``cold_chain_sec`` runs the longest chain (documents -> tokens ->
shards -> batches -> next-token table -> val loss) from nothing, and
``bpe_pack_sec`` packs the corpus as byte-pair tokens of the given rank table;
``slots_sec`` writes the slot table that the batch queries scan.

``value`` sums the queries of the earlier rounds' list (``HEADLINE``), the
packing and the slot table, so rounds compare; ``queries`` has every key.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tokenweave.params import RANKED  # noqa: E402
from tokenweave.plans.catalog import QUERIES  # noqa: E402
from tokenweave.plans.run import clear_runs, get_run  # noqa: E402
from tokenweave.session import build_session  # noqa: E402

HEADLINE = [
    "corpus_scan", "doc_token_lengths", "word_vocab", "doc_offsets", "shard_segments",
    "shard_manifest", "shard_token_checksum", "token_range_check", "list_shards",
    "batch_schedule", "batches", "next_token_pairs", "accumulation_plan", "tokens_per_step",
    "ngram_model", "cross_entropy", "val_loss", "train_loss_by_step", "train_loss_online",
    "val_curve",
    "softmax", "topk_per_group", "weighted_sample", "global_norm_clip", "encode_prompts",
    "decode_roundtrip", "generate",
]


def clock(job) -> float:
    t0 = time.time()
    job()
    return round(time.time() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    asked = sys.argv[1].split(",") if len(sys.argv) > 1 else [*HEADLINE, *(n for n in QUERIES if n not in HEADLINE)]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          app="tokenweave-bench")
    # JVM and Python worker warm-up on the smallest table, not timed.
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    run_query = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    clear_runs(spark)
    cold_chain = clock(lambda: run_query("val_loss"))
    print(f"# cold chain (val_loss from documents): {cold_chain}s", file=sys.stderr, flush=True)

    clear_runs(spark)
    run = get_run(spark, sf_dir)
    pack = clock(lambda: run.shards_path)  # tokenise, offsets, cut, write shards
    slots = clock(lambda: run.slots_path)  # the shards cut at slot borders, once for all batch queries
    n_tokens = int(run.lengths.agg({"L": "sum"}).first()[0])
    ranked = get_run(spark, sf_dir, RANKED)
    bpe_pack = clock(lambda: ranked.shards_path)
    bpe_slots = clock(lambda: ranked.slots_path)
    n_bpe = int(ranked.lengths.agg({"L": "sum"}).first()[0])

    times: dict[str, float] = {}
    for name in asked:
        if name in QUERIES:
            times[name] = clock(lambda: run_query(name))  # noqa: B023
            print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)

    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.get(n, 0) for n in HEADLINE) + pack + slots, 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "pack_sec": pack,
        "tokens": n_tokens,
        "pack_tokens_per_sec": round(n_tokens / pack, 1) if pack else None,
        "slots_sec": slots,
        "bpe_pack_sec": bpe_pack,
        "bpe_slots_sec": bpe_slots,
        "bpe_tokens": n_bpe,
        "bpe_pack_tokens_per_sec": round(n_bpe / bpe_pack, 1) if bpe_pack else None,
        "cold_chain_sec": cold_chain,
        "all_queries_sec": round(sum(times.values()) + pack + slots + bpe_pack + bpe_slots, 3),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
