"""Corpus readers, shard sink/discovery, metrics log."""

import pytest

from conftest import SF001
from tokenweave.sources import metrics as metrics_io
from tokenweave.sources import shards as shard_io
from tokenweave.sources.corpus import read_corpus, table_path


@pytest.mark.parametrize("fmt", ["json", "csv", "orc"])
def test_corpus_readers_agree(spark, tmp_path, fmt):
    src = spark.read.parquet(table_path(SF001, "documents")).select("doc_id", "text", "lang")
    path = str(tmp_path / fmt)
    src.write.format(fmt).option("header", "true").option("escape", '"').save(path)
    schema = "doc_id bigint, text string, lang string" if fmt != "orc" else None
    got = read_corpus(spark, path, fmt=fmt, schema=schema)
    want = read_corpus(spark, table_path(SF001, "documents"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_split_choice_is_pushed_to_the_scan(spark):
    from conftest import formatted_plan
    df = read_corpus(spark, table_path(SF001, "documents"), where="lang = 'en'")
    plan = formatted_plan(df)
    assert "PushedFilters" in plan and "lang" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan
    n = spark.read.parquet(table_path(SF001, "documents")).filter("lang = 'en'").count()
    assert df.count() == n


def test_a_corpus_without_a_key_packs_in_file_order(spark, tmp_path):
    """Many files, many row groups, few or many tasks: the same places and the same segments on every run."""
    from tokenweave.operators import packing
    from tokenweave.plans.run import byte_offsets

    texts = [f"text {i} " * (i % 7) for i in range(400)]
    src = spark.createDataFrame([(t, "x") for t in texts], "text string, doc_id string").coalesce(1)
    path = tmp_path / "raw"
    for k in range(5):
        part = spark.createDataFrame([(t if t else None, "x") for t in texts[80 * k:80 * k + 80]], src.schema).coalesce(1)
        part.write.option("parquet.block.size", "1024").parquet(str(path / f"part-{k}"))
    path = str(path / "part-*")
    runs = []
    for size in ("128m", "400"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        docs = read_corpus(spark, path, key=None)
        assert [r.text for r in docs.orderBy("doc_id").collect()] == texts
        assert [r.doc_id for r in docs.orderBy("doc_id").collect()] == list(range(400))
        seg = packing.cut_segments(byte_offsets(docs), 500)
        runs.append(sorted(tuple(r) for r in seg.select("shard_index", "pos", "doc_id", "n", "data").collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert runs[0] == runs[1] and sum(r[3] for r in runs[0]) == sum(len(t) + 1 for t in texts)
    with pytest.raises(ValueError, match="key column"):
        read_corpus(spark, path, key=None, fmt="csv")


def test_missing_split_raises(spark, tmp_path):
    segs = spark.createDataFrame([("val", 0, 0, 0, 0, 3, 3, [1, 2, 3])],
                                 "split string, shard_index bigint, pos bigint, doc_id bigint, "
                                 "src bigint, n bigint, doc_n bigint, ids array<int>")
    path = shard_io.write_shards(segs, str(tmp_path / "s"), 10)
    with pytest.raises(ValueError, match="train table"):
        shard_io.list_shards(spark, path, "train")
    with pytest.raises(ValueError):
        shard_io.read_shards(spark, path, "test")


def test_metrics_truncate_then_append(spark, tmp_path):
    rows = spark.createDataFrame([(0, "val", 3.25304), (100, "val", 3.14969)], "step bigint, split string, loss double")
    path = str(tmp_path / "log")
    metrics_io.write_metrics(metrics_io.metrics_lines(rows.filter("step = 0")), path, truncate=True)
    metrics_io.write_metrics(metrics_io.metrics_lines(rows.filter("step = 100")), path)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["0 val 3.2530", "100 val 3.1497"]
    parsed = sorted(tuple(r) for r in metrics_io.parse_metrics(spark, path).collect())
    assert parsed == [(0, "val", 3.253), (100, "val", 3.1497)]
    # the same evaluation written again, as after a failure, leaves one line
    metrics_io.write_metrics(metrics_io.metrics_lines(rows.filter("step = 100")), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == lines
    # a new run truncates
    metrics_io.write_metrics(metrics_io.metrics_lines(rows.filter("step = 0")), path, truncate=True)
    assert spark.read.text(path).count() == 1


def test_out_of_range_ids_never_reach_a_shard(spark, tmp_path):
    segs = spark.createDataFrame([("val", 0, 0, 0, 0, 2, 2, [1, 65536])],
                                 "split string, shard_index bigint, pos bigint, doc_id bigint, "
                                 "src bigint, n bigint, doc_n bigint, ids array<int>")
    with pytest.raises(Exception, match="16 bits"):
        shard_io.write_shards(segs, str(tmp_path / "s"), 10)


def test_step_report_rate(spark):
    df = spark.createDataFrame([(3, 2.5, 1000, 0.5)], "step bigint, loss double, tokens bigint, sec double")
    assert metrics_io.step_report(df).first().line == "step    3 | loss: 2.500000 | tokens: 1000"
    assert metrics_io.step_report(df, "sec").first().line.endswith(" | tok/sec: 2000.00")
