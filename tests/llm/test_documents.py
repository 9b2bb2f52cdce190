"""Fingerprints, SimHash, decontamination, quality and language model on small fixtures, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenweave.llm import decontam, maxent, merkle, qda, simhash
from tokenweave.llm.common import crc_mod

SCHEMA = "doc_id bigint, text string"


# ---------------------------------------------------------------- fingerprints

def successors(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (key, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        out[key] = (text, text[:len(text) - half] + after[:half], after)
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 60])
def test_successors_and_fingerprints(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(-5, 10 ** 12), n)
    sentence = lambda: " ".join(rng.choice(["é😀", "aa", "bb", "ccc"]) for _ in range(rng.randint(1, 9))) + rng.choice([".", "\n", " ", "!\n\n"])
    rows = [(i, "".join(sentence() for _ in range(rng.randint(0, 20)))) for i in ids]
    if n == 60:
        rows[3], rows[4] = (None, "null id."), (rows[4][0], None)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", bin string, copy int").repartition(3)
    got = merkle.fingerprint_successors(df).collect()
    want = successors(rows)
    assert len(got) == n
    for r in got:
        text, edited, after = want[r.doc_id]
        fp = merkle.fingerprint
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fp(text), fp(edited))
        assert (r.near_edited, r.near_next) == (merkle.likeness(fp(text), fp(edited)), merkle.likeness(fp(text), fp(after)))


def test_repeated_ids_keep_every_row(spark):
    rows = [(5, "a b c."), (5, "d e f."), (5, "a b c."), (4, None)]
    got = merkle.fingerprint_successors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got) == [(4, 0), (5, 6), (5, 6), (5, 6)]


def test_null_and_repeated_ids_are_spread_and_keep_their_order(spark):
    ids = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(77)).otherwise(F.col("id") % 500)
    df = spark.range(3000).select(ids.cast("bigint").alias("doc_id"), F.sha2((F.col("id") % 2900).cast("string"), 256).alias("text")).repartition(5)
    binned = merkle._in_order(df, "doc_id", "text").where("not copy")
    sizes = [r["count"] for r in binned.groupBy("bin").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 400  # a third in one bin would be 1,000
    rows = [r.text for r in df.orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text")).collect()]
    want = sorted(hashlib.sha256((a[:32] + b[:32]).encode()).hexdigest() for a, b in zip(rows, rows[1:] + rows[:1]))
    got = merkle.fingerprint_successors(df).collect()
    assert sorted(r.edited_sha256 for r in got) == want


def test_tree_locates_edits():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(6))
    lines = [" ".join(word() for _ in range(8)) + "." for _ in range(60)]
    text = "\n".join(lines)
    changed = list(lines)
    changed[30] = "entirely new words here."
    new = "\n".join(changed)
    a, b = merkle.fingerprint(text), merkle.fingerprint(new)
    start = new.index("entirely")
    assert merkle.changed_ranges(a, b) == [(start, start + len(changed[30]))]
    assert merkle.changed_ranges(a, a) == [] and 0.9 < merkle.likeness(a, b) < 1
    sections = [{n for n, _ in merkle.parse(x)} for x in (a, b)]
    assert len(sections[0]) > 2 and 0 < len(sections[0] ^ sections[1]) <= 4  # the edit's branch differs
    assert merkle.fingerprint("") != merkle.fingerprint("\n") and merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("x")) == 0


# ---------------------------------------------------------------- SimHash

def brute_simhash(text, k):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("split_rows", [4096, 2])
def test_simhash_components_equal_brute_force(spark, split_rows):
    rng = random.Random(9)
    base = [" ".join(rng.choice(["a", "B", "cc", "d\x0be", "é"]) for _ in range(rng.choice([0, 1, 2, 3, 40, 300]))) for _ in range(60)]
    texts = base + [t.replace("cc", "CC", 1) + rng.choice(["", " x"]) for t in base] + [t + " a" for t in base[:30]] + [None, "", "  "]
    rows = [(i * 3 if i != 7 else None, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = simhash.near_duplicates(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", fp int").repartition(4), 3, 2, split_rows=split_rows).collect()
    fps = [brute_simhash(t, 3) for _, t in rows]
    comp = brute_components(fps, 2)
    lowest = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            lowest[c] = min(lowest.get(c, i), i)
    want = sorted((str(i), f"{f:016x}", str(lowest.get(c))) for (i, _), f, c in zip(rows, fps, comp))
    assert sorted((str(r.id), f"{r.fp & (1 << 64) - 1:016x}", str(r.component_id)) for r in got) == want
    assert len(set(comp)) < len(set(fps))


def test_index_finds_every_link():
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    codes = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(600)}
    codes = np.array(sorted(codes), np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    i, j = simhash.links(codes, 2)
    want = {(a, b) for a in range(len(codes)) for b in range(a + 1, len(codes)) if int(np.bitwise_count(codes[a] ^ codes[b])) <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want) > 100


def test_long_chains_join(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 999), (5, 5)], "u bigint, v bigint")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 1000: 999}


def test_keep_one_of_each_group(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    rows = [(9, a, "x"), (4, a, "y"), (4, a, "y"), (4, b, "z"), (None, a, "n"), (None, "only null ids here", "n"), (None, "only null ids here", "m"), (2, None, None)]
    got = simhash.keep_one(spark.createDataFrame(rows, SCHEMA + ", _sh_id_ string"), 3, 2).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == [("2", "None"), ("4", a), ("4", b), ("None", "only null ids here")]
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.keep_one(empty, 3, 2).collect() == [] == simhash.near_duplicates(empty, 3, 2).collect()


# ---------------------------------------------------------------- decontamination

def brute_leaks(docs, items, k=5, threshold=0.8):
    out = set()
    for i, t in docs:
        words = decontam.words_of((t or "").encode())
        for j, item in items:
            own = decontam.words_of((item or "").encode())
            n = min(len(own), len(words))
            best = max((decontam.similarity(decontam.shingles(words[s:s + n], k), decontam.shingles(own, k))
                        for s in range(len(words) - n + 1)), default=0.0) if own and words else 0.0
            if best >= threshold:
                out.add((i, j, round(best, 9)))
    return out


def test_windows_of_a_long_text_are_looked_at_in_stretches(monkeypatch):
    rng = random.Random(12)
    words = [f"w{rng.randrange(30)}" for _ in range(4000)]
    items = [(i, " ".join(words[s:s + 20])) for i, s in enumerate(range(0, 4000, 90))]
    index = decontam.Index([(i, t.encode()) for i, t in items], 5)
    text = " ".join(words).encode()
    whole = decontam.matches_of(index, text, 0.8)
    monkeypatch.setattr(decontam, "STRETCH", 64)
    assert decontam.matches_of(index, text, 0.8) == whole and {x["item_id"] for x in whole} == {i for i, _ in items}


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(j, " ".join(text(rng.choice([3, 4, 5, 14, 20, 30, 59])))) for j in range(30)] + [(90, None), (91, ""), (92, "Fünf Wörter, sind: kein Satz!")]
    items.append((93, items[5][1]))
    docs = [(0, None), (1, ""), (2, "fünf wörter sind KEIN satz"), (3, " ".join(text(400)))]
    for d in range(4, 70):
        own = items[rng.randrange(30)][1].split()
        at = rng.randrange(len(own))
        kind = rng.randrange(5)
        if kind == 1:
            own[at] = "changed"
        elif kind == 2:
            own = own[rng.randint(0, 3):]
        elif kind == 3:
            own.insert(at, "more")
        elif kind == 4:
            own = own[:-rng.randint(1, 3)]
        docs.append((d, " ".join(text(rng.choice([0, 10, 80])) + [w.upper() + rng.choice(["", ",", "!!"]) for w in own] + text(rng.choice([0, 25])))))
    df = spark.createDataFrame([(*r, 1) for r in docs], SCHEMA + ", Leaks int").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (4096, 7):
        rows = decontam.find_leaks(df, bench, block_items=block).select("doc_id", F.explode("leaks").alias("x")).collect()
        assert {(r.doc_id, r.x.item_id, round(r.x.similarity, 9)) for r in rows} == brute_leaks(docs, items)
    assert len(rows) > 20
    assert decontam.find_leaks(df, bench.limit(0)).where(F.size("leaks") > 0).collect() == []
    assert decontam.find_leaks(df.limit(0), bench).collect() == []


def test_multi_index_holds_its_radius():
    assert decontam.BLOCKS * (decontam.FLIPS + 1) > decontam.RADIUS
    rng = random.Random(5)
    index = decontam.Index([(0, b"some words of an item that is long enough")], 5)
    members, codes, table = index.tables[9]
    for _ in range(2000):
        code = codes[0] ^ np.uint64(sum(1 << b for b in rng.sample(range(64), decontam.RADIUS)))
        own = np.array([code]).view(np.uint8)
        assert any(table[b, own[b], 0] for b in range(decontam.BLOCKS))


# ---------------------------------------------------------------- quality

def quality_rows(n=400):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 120))]
        text = " ".join(w + ("" if good else rng.choice(["###", "$$$", "!!"])) for w in words) + "."
        rows.append((i, text))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_separates_held_out_rows(spark):
    rows, labels = quality_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    stats = qda.document_statistics(docs)
    held = crc_mod(F.col("id"), 5) == 0
    model = qda.fit(stats.where(~held), spark.createDataFrame(labels, "doc_id bigint, quality int"))
    got = {r.id: r.score for r in qda.score(stats.where(held), model).collect()}
    assert set(got) == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    truth = dict(labels)
    assert np.mean([(s >= 0.3) == bool(truth[i]) for i, s in got.items()]) > 0.97
    # the difference of log densities by the textbook formula
    x = np.array([qda.statistics(t.encode()) for _, t in rows[:20]])
    words = np.expm1(x[:, 1])
    z = np.clip((x - model.mean) / model.scale, -qda.CLIP, qda.CLIP) * np.sqrt(words / (words + qda.SHORT))[:, None]
    covs = [np.linalg.inv(f) @ np.linalg.inv(f).T for f in model.inverse_factors]
    logs = [-0.5 * np.einsum("ni,ij,nj->n", z - m, np.linalg.inv(c), z - m) - 0.5 * np.linalg.slogdet(c)[1] for m, c in zip(model.centres, covs)]
    assert np.allclose(model.difference(x), logs[1] - logs[0] + model.log_prior)


def test_quality_edge_rows(spark):
    rows, labels = quality_rows(80)
    rows += [(500, None), (501, ""), (502, "x" * 200_000), (3, "again"), (None, "no id")]
    labels += [(1, None), (2, 7), (None, 1), (4, 0), (9999, 1)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], SCHEMA + ", score double")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    stats = qda.document_statistics(docs)
    scores = qda.score(stats, qda.fit(stats, marks)).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    ones = qda.fit(stats, marks.where("quality = 1"))
    assert {r.score for r in qda.score(stats, ones).collect()} == {1.0}
    none = qda.fit(stats, marks.limit(0))
    assert docs.where(qda.score_column(none, F.col("text")) < 1).collect() == []
    assert qda.score(qda.document_statistics(docs.limit(0)), ones).collect() == []


# ---------------------------------------------------------------- language model

def lm_rows(n=300):
    rng = random.Random(7)
    pairs = {"the": ["cat", "dog"], "cat": ["sat", "ran"], "dog": ["ran"], "sat": ["the", "on"], "ran": ["the"], "on": ["the"]}
    rows = []
    for i in range(n):
        w, out = "the", []
        for _ in range(rng.randint(0, 60)):
            out.append(w.upper() if rng.random() < 0.1 else w)
            w = rng.choice(pairs[w]) if rng.random() < 0.9 else f"rare{rng.randrange(500)}"
            pairs.setdefault(w, ["the"])
        rows.append((i, " ".join(out)))
    return rows + [(1000, None), (1001, ""), (1001, ""), (1002, "novel " * 3), (None, "the cat"), (7, "again")]


@pytest.mark.parametrize("frequent", [65_536, 5])
def test_base_scores_equal_brute_force(spark, frequent):
    rows = lm_rows()
    p = maxent.LMParams(head=6, tail=10, hashed=64, frequent=frequent, rounds=8)
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", key int").repartition(3)
    got = maxent.score_texts(docs, crc_mod(F.col("doc_id"), 7) == 2, p).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    words = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in rows]
    c = Counter(w for i, ws in words if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in words)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    own = [r for r in got if r.held_out]
    assert own and sum(r.score for r in own) > sum(r.base_score for r in own)
    assert all(r.score <= 0 for r in got)


def test_training_raises_the_fit_and_normalises(spark):
    p = maxent.LMParams(head=6, tail=10, hashed=64, rounds=10)
    rng = random.Random(8)
    texts = [bytes(rng.choice([0, 1, 2]) if rng.random() < 0.3 else (i * 3) % 16 for i in range(50)) for _ in range(40)]
    rows = spark.createDataFrame([(False, bytearray(t)) for t in texts], "held_out boolean, classes binary")
    weights, fits = maxent.train(rows, p)
    assert fits[-1] > fits[1] > fits[0]
    total = np.exp(weights.log_probabilities(np.arange(256))).sum(axis=1)
    assert np.allclose(total, 1)


def test_each_class_context_has_its_own_trigram_row():
    p = maxent.LMParams()
    rows = maxent.Weights(p).features(np.arange(p.classes ** 2))[3]
    assert len(np.unique(rows)) == p.classes ** 2 and rows.max() < p.hashed


def test_own_trigram_rows_learn_each_context(spark):
    # the class after depends on both classes before: their sum modulo 16
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        t = [rng.randrange(16), rng.randrange(16)]
        for _ in range(60):
            t.append((t[-1] + t[-2]) % 16 if rng.random() < 0.9 else rng.randrange(16))
        texts.append(bytes(t))
    rows = spark.createDataFrame([(False, bytearray(t)) for t in texts], "held_out boolean, classes binary").repartition(3)
    fits = {}
    for hashed, tasks in ((256, 1), (256, 4), (32, 4)):
        weights, fits[hashed, tasks] = maxent.train(rows, maxent.LMParams(head=6, tail=10, hashed=hashed, gradient_tasks=tasks))
        assert np.allclose(np.exp(weights.log_probabilities(np.arange(256))).sum(axis=1), 1)
    assert np.allclose(fits[256, 1], fits[256, 4], rtol=1e-4)
    assert fits[256, 4][-1] > fits[32, 4][-1]


def test_language_model_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    p = maxent.LMParams(head=4, tail=4, hashed=16, rounds=2)
    got = maxent.score_texts(docs, F.lit(True), p).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in sorted(got, key=lambda r: r.doc_id)] == [(0, 0, 0.0), (0, 0, 0.0)]
    assert maxent.score_texts(docs.limit(0), F.lit(False), p).collect() == []


def test_words_of_a_class_follow_the_words_before(spark):
    # all words of a kind share an ending and so a class; which of them comes next depends on the word before
    rng = random.Random(10)
    names = [f"w{i}" for i in range(6)]
    rows = [(i, " ".join(f"{n}ing {n}ed" for n in rng.choices(names, k=20))) for i in range(200)]
    pairs = list(zip(names, names[1:] + names[:1]))
    rows += [(1000, " ".join(f"{n}ing {n}ed" for n, _ in pairs)), (1001, " ".join(f"{n}ing {o}ed" for n, o in pairs))]
    p = maxent.LMParams(head=1, tail=10, hashed=121, rounds=4, word_hashed_bits=12, word_rounds=4, word_prior=1.0)
    got = {r.doc_id: r for r in maxent.score_texts(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") >= 1000, p).collect()}
    assert got[1000].base_score == pytest.approx(got[1001].base_score)
    assert got[1000].score > got[1001].score + 1


def test_word_trees_raise_the_fit_and_normalise(spark):
    p = maxent.LMParams(head=2, tail=6, bits=3, word_hashed_bits=8, word_rounds=4, word_prior=1.0)
    rng = random.Random(11)
    rows = []
    for _ in range(60):
        classes, leaves = [2], [0]
        for _ in range(40):
            classes.append(rng.randrange(2, 8))
            leaves.append((leaves[-1] + 1) % 8 if rng.random() < 0.8 else rng.randrange(8))
        rows.append((False, bytearray(classes), bytearray(np.array(leaves, "<u2").tobytes())))
    weights, fits = maxent.train_words(spark.createDataFrame(rows, "held_out boolean, classes binary, leaves binary").repartition(3), p)
    assert len(fits) == 4 and fits[3] > fits[1] > fits[0]
    for before, skip in ((2 << 3 | 5, 3 << 3 | 1), (0, 0), (7 << 3, 2 << 3 | 7)):
        words = np.arange(4 << 3, 5 << 3)
        total = np.exp(weights.log_probabilities(words, np.full(8, before), np.full(8, skip))).sum()
        assert total == pytest.approx(1, abs=1e-5)
