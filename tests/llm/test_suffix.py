"""Suffix dedup against brute force over every string of the length."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenweave.llm import suffix
from tokenweave.llm.suffix import SuffixParams


def brute(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def corpus(seed, n=40):
    rng = random.Random(seed)
    word = lambda: rng.choice(["aé", "b", "cc", "aab", "x", "yy "]) * rng.randint(1, 2)
    passages = ["".join(word() for _ in range(rng.randint(5, 80))) for _ in range(6)]
    docs = []
    for _ in range(n):
        t = ""
        for _ in range(rng.randint(0, 4)):
            x = rng.choice(passages)
            if rng.random() < 0.4:
                k = rng.randrange(len(x))
                x = x[:k] + word() + x[k + 1:]
            t += x[rng.randrange(3):] + "".join(word() for _ in range(rng.randint(0, 12)))
        docs.append(t)
    return docs + ["", "a" * 300, "ab" * 90, "short", passages[0], passages[0]]


def run(spark, texts, p, **kw):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    return sorted(suffix.remove_repeats(df, p, **kw).collect(), key=lambda r: r.doc_id)


@pytest.mark.parametrize("seed,p", [
    (1, SuffixParams(length=20, seed=6)),
    (2, SuffixParams(length=20, seed=6, group_rows=3)),  # nearly every seed takes the path for frequent ones
    (3, SuffixParams(length=30, seed=12, pair_rows=2, run_rows=50)),  # classes for each distance, many short runs
    (4, SuffixParams(length=40, seed=8, group_rows=30, pair_rows=3)),
    (5, SuffixParams(length=24, seed=8, group_rows=1)),  # halves down to single distances
])
def test_equals_brute_force(spark, seed, p):
    texts = corpus(seed)
    want = brute([t.encode() for t in texts], p.length)
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in run(spark, texts, p)]
    assert got == want
    assert any(w[1] for w in want) and any(w[0] and not w[1] for w in want)


def test_edge_rows(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    rows = [(1, None), (1, long), (None, "x" + long[100:900]), (None, None), (7, "y"), (7, "y")]
    df = spark.createDataFrame([(a, b, 0, "q") for a, b in rows], "doc_id bigint, text string, begin int, marks string")
    got = suffix.remove_repeats(df, SuffixParams(length=50, seed=10), keep_bytes=False).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in got) == [
        (-1, 0, 0), (-1, 801, 800), (1, 0, 0), (1, 5000, 800), (7, 1, 0), (7, 1, 0)]
    assert suffix.remove_repeats(df.limit(0)).collect() == []


def test_repeated_rows_remove_each_other(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(700))
    df = spark.createDataFrame([(3, text), (3, text), (4, text[:199])], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_removed) for r in suffix.remove_repeats(df).collect())
    assert got == [(3, 700), (3, 700), (4, 0)]


def test_long_text_over_several_steps(monkeypatch):
    rng = random.Random(7)
    text = "".join(rng.choice("abcd") for _ in range(3000)).encode()
    p = SuffixParams(length=40, seed=8)
    whole = suffix.picks(text, p)
    monkeypatch.setattr(suffix, "_STEP", 256)
    place, near, far, _ = suffix.picks(text, p)
    # every window start is owned by exactly one pick, the leftmost smallest of its window, at any step size
    starts = lambda a, n, f: sorted((x - d, x) for x, lo, hi in zip(a, n, f) for d in range(lo, hi + 1))
    assert starts(place, near, far) == starts(*whole[:3])
    assert [s for s, _ in starts(place, near, far)] == list(range(3000 - 40 + 1))


def test_merge_orders_and_shares_prefixes():
    rng = random.Random(8)
    words = lambda n: sorted((bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 9))), b"", i, 0, 0) for i in range(n))
    runs = [words(rng.randint(0, 30)) for _ in range(7)]
    coded = [suffix.decode_run(suffix.encode_run(r)) for r in runs if r]
    merged = list(suffix.merge_runs(coded))
    keys = [s[0] for _, s in merged]
    assert keys == sorted(s[0] for r in runs for s in r)
    assert [c for c, _ in merged[1:]] == [suffix.common_prefix(a, b) for a, b in zip(keys, keys[1:])]
    assert list(suffix.merge_runs([])) == []


def test_null_ids_whose_hashes_agree_in_31_bits_keep_their_own_ranges(spark):
    text = F.concat(*[F.sha2(F.concat("id", F.lit(c)).cast("string"), 256) for c in "abcd"])
    low = F.xxhash64(text.cast("binary"), F.lit(True)).bitwiseAND(F.lit((1 << 31) - 1))
    pair = (spark.range(200_000).select(low.alias("h"), text.alias("text")).groupBy("h")
            .agg(F.sort_array(F.collect_list("text")).alias("texts")).where(F.size("texts") == 2).first())
    a, b = pair.texts
    df = spark.createDataFrame([(None, a), (None, b), (1, "é" + a)], "doc_id bigint, text string")
    got = suffix.remove_repeats(df).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == sorted([
        (0, 256, 256, b""), (0, 256, 0, b.encode()), (1, 258, 256, "é".encode())])


def test_a_passage_of_all_documents_is_divided_and_equals_brute_force(spark):
    rng = random.Random(9)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = some(150)
    texts = [some(rng.randint(0, 60)) + passage + some(rng.randint(0, 60)) for _ in range(60)] + [passage * 3]
    p = SuffixParams(length=40, seed=8, group_rows=10)
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in run(spark, texts, p)]
    assert got == brute([t.encode() for t in texts], p.length)


def test_halves_are_few_rows_and_equal_contexts_one():
    rng = random.Random(10)
    some = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    p, passage = SuffixParams(), some(1000)
    texts = [some(300) + passage + some(300) for _ in range(50)]
    marks = [[{"at": int(a) << 16 | int(n) << 8 | int(z), "seed": int(h)} for a, n, z, h in zip(*suffix.picks(t, p)) if 300 <= a <= 1268]
             for t in texts]
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"doc": list(range(50)), "salt": [0] * 50, "text": pa.array(texts, pa.binary()), "marks": marks})
    rows = [r for b in suffix._halves(p, suffix._whole_classes)(iter([batch])) for r in b.to_pylist()]
    inside = [r for r in rows if r["key"] is None]
    assert len(inside) == 50  # one joined range a document, however many suffixes the passage has
    assert len(rows) - 50 < 50 * 8  # two rows for each suffix at an edge, not one for each of its 169 windows


def test_sent_suffixes_do_not_grow_with_the_square_of_equal_rows(spark, monkeypatch):
    rng = random.Random(11)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))

    def sent(k):
        df = spark.createDataFrame([(None, text)] * k + [(1, "xy" + text)], "doc_id bigint, text string").repartition(4)
        seen = []
        keep = suffix._merged
        monkeypatch.setattr(suffix, "_merged", lambda runs, p: seen.append(runs) or keep(runs, p))
        got = suffix.remove_repeats(df, keep_bytes=False).collect()
        monkeypatch.setattr(suffix, "_merged", keep)
        assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in got) == [(0, 3000, 3000, 1)] * k + [(1, 3002, 3000, 1)]
        return sum(len(list(suffix.decode_run(r.run))) for r in seen[0].collect())

    few, many = sent(5), sent(80)
    assert many <= 4 * few  # at most once a task, not once a copy
