"""Registered queries: against their DuckDB SQL, plan shapes, and the pipeline against brute force."""

import zlib

import corpus_pipeline as pipeline
import duckdb
import pytest
from conftest import SF001
from pyspark.sql import functions as F
from test_documents import brute_components, brute_leaks, brute_simhash
from tokenweave.llm import decontam, pii, qda
from tokenweave.llm.common import materialise, table
from tokenweave.llm.queries import ORACLE_SQL, QUERIES

TABLES = "documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    cols = sorted(df.columns)
    res = con.sql(ORACLE_SQL[name])
    assert sorted(res.columns) == cols
    at = [res.columns.index(c) for c in cols]
    want = sorted(repr([r[i] for i in at]) for r in res.fetchall())
    assert sorted(repr([r[c] for c in cols]) for r in df.collect()) == want


@pytest.mark.parametrize("name", ["op2_pii", "op5_chat_format"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_pipeline_stages_equal_brute_force(spark):
    """Each stage on its own input, as the one before wrote it."""
    docs, kept = table(spark, SF001, "documents"), {}
    names = docs.columns
    for name, stage in pipeline.STAGES:
        before = docs
        docs = materialise(stage(spark, docs, SF001), f"test-{name}")
        kept[name] = (before, docs)
        assert name == "mixing" or docs.columns == names

    before, after = kept["quality"]
    model = qda.fit(qda.document_statistics(before), table(spark, SF001, "labels"))
    scores = {r.id: r.score for r in qda.score(qda.document_statistics(before), model).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, s in scores.items() if s >= 0.3}
    marks = {r.doc_id: r.quality for r in table(spark, SF001, "labels").collect()}
    assert sum((scores[i] >= 0.3) == bool(q) for i, q in marks.items()) >= 0.95 * len(marks)

    before, after = kept["near_duplicates"]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    comp = brute_components([brute_simhash(t, 3) for _, t in rows], 2)
    assert {r.doc_id for r in after.collect()} == {min(i for (i, _), d in zip(rows, comp) if d == c) for c in set(comp)}

    before, after = kept["benchmark_passages"]
    bench = [(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect()]
    own = {s for _, t in bench for s in decontam.shingles(decontam.words_of(t.encode()), 5)}
    # brute force over the documents that have any shingle of an item; the others have similarity 0
    some = [(r.doc_id, r.text) for r in before.collect() if own & decontam.shingles(decontam.words_of(r.text.encode()), 5).keys()]
    leaks = {d for d, _, _ in brute_leaks(some, bench)}
    assert leaks and {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == leaks

    before, after = kept["personal_data"]
    found = pii.find_pii(before).withColumnRenamed("text", "old").join(after.select("doc_id", "text", F.col("n_chars").alias("n")), "doc_id").collect()
    assert any(r.pii for r in found) and len(found) == before.count()
    for r in found:
        text, at = "", 0
        for s in r.pii:
            if s.start >= at:
                text += r.old[at:s.start] + f"[{s.kind.upper()}]"
            at = max(at, s.end)
        assert r.text == text + r.old[at:] and r.n == len(r.text)

    before, after = kept["mixing"]
    got = after.collect()
    sizes = {r.doc_id: len(r.text.split()) for r in before.collect()}
    assert {r.doc_id: r.size for r in got} == sizes
    for source in {r.source for r in got}:
        rows = [r for r in got if r.source == source]
        assert sum(r.taken for r in rows) == int(rows[0].target) and all(r.taken <= 3 * r.size for r in rows)


def test_pipeline_takes_edge_rows(spark, tmp_path):
    docs = table(spark, SF001, "documents").limit(60).withColumn("_row", F.lit(1)).withColumn("leaks", F.lit("x"))
    extra = spark.createDataFrame([(None, None, None, None, None, 1, "x"), (900, None, "en", None, 0, 1, "x"), (901, "", "en", "src1", 0, 1, "x")],
                                  docs.schema)
    rows = docs.union(docs.limit(5)).union(extra)
    for _, stage in pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF001)
    assert rows.columns == docs.columns
    assert pipeline.mixing(spark, rows, SF001).count() == rows.count()
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        empty = stage(spark, empty, SF001)
    assert empty.collect() == []


def test_held_out_rule(spark):
    got = {r.doc_id: r.held_out for r in QUERIES["op3_quality"](spark, SF001).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got}
