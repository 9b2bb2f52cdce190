"""Plan shape of every registered query.

No products, no row-at-a-time Python, and no single-partition exchange
over token-, document- or pair-level rows (SURVEY §4 and §5): whatever goes
to one task is a table bounded by parameters or a merge of partial results.
"""

import re

import pytest

from conftest import SF001, exchange_inputs

from tokenweave.plans.catalog import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
ROW_LEVEL = {"ids", "text", "doc_id", "pos", "x", "y", "word", "pretoken", "sym", "buf"}


def input_columns(line: str) -> set[str]:
    """Column names of an ``Input [n]: [a#1L, b#2]`` line of the formatted plan."""
    m = re.search(r"Input \[\d+\]: \[(.*)\]", line)
    return {re.sub(r"#\d+L?$", "", c.strip()) for c in m.group(1).split(",")} if m else set()


def test_check_flags_a_global_running_sum(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(100).select(F.col("id").alias("doc_id"), F.lit(3).alias("n"))
    bad = df.withColumn("off", F.sum("n").over(Window.orderBy("doc_id")))
    single = [input_columns(i) for a, i in exchange_inputs(bad) if "SinglePartition" in a]
    assert single and all("doc_id" in c for c in single)


# learn_bpe_vocabulary is learn_bpe_merges with more rounds
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"learn_bpe_vocabulary"}))
def test_plan_shape(spark, name):
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad} in plan"
    for args, inputs in exchange_inputs(df):
        if "SinglePartition" in args:
            cols = input_columns(inputs)
            assert not (cols & ROW_LEVEL), f"{name}: single-partition exchange over {cols & ROW_LEVEL}"


def test_lengths_need_no_encoder(spark):
    for name in ("shard_manifest", "segment_group_totals", "doc_offsets"):
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "Arrow" not in plan, name


@pytest.mark.parametrize("name", ["batches", "batch_rows", "val_batches", "next_token_pairs", "shard_token_checksum", "bpe_batches"])
def test_batch_queries_shuffle_no_tokens(spark, name):
    """The slot table is scanned where it lies: only counts and sums are exchanged."""
    for args, inputs in exchange_inputs(QUERIES[name](spark, SF001)):
        assert not input_columns(inputs) & {"buf", "data", "ids", "piece"}, (name, args, inputs)


def test_tokens_per_step_reads_no_token(spark):
    plan = QUERIES["tokens_per_step"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan
