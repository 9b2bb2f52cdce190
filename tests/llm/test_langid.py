"""Language network: gradients, brute-force scores, edge rows, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from conftest import SF01
from tokenweave.llm import langid
from tokenweave.llm.common import table
from tokenweave.llm.queries import QUERIES

SMALL = langid.NetParams(texts_per_language=60, steps=60, window=32, filters=4, embedding=4)


def small_net(langs=("a", "b", "c")):
    return langid.new_net(list(langs), SMALL)


def brute_window(net, row):
    """Probabilities of one padded window, place by place."""
    x, kept = net.embed[row].astype(float), []
    for w, b in zip(net.filters, net.bias):
        answers = [sum(x[t + j] @ w[j] for j in range(len(w))) for t in range(len(row) - len(w) + 1)]
        kept += list(np.maximum(np.max(answers, axis=0) + b, 0))
    z = np.exp(np.array(kept) @ net.dense + net.dense_bias)
    return z / z.sum()


def brute_score(net, text, window=32):
    text, total, weights = text.lower(), 0, 0
    for at in range(0, max(1, len(text) - 4), window - 4):
        part = list(text[at:at + window])
        weight = max(1, min(window - 4, len(text) - at))
        total, weights = total + weight * brute_window(net, np.array(part + [langid.PAD] * (window - len(part)))), weights + weight
    return total / weights


def test_scores_equal_brute_force():
    net, rng = small_net(), random.Random(1)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 3, 4, 5, 31, 32, 33, 60, 61, 500)]
    got = langid.Windows(net, 32, batch=7).score(texts)
    assert np.allclose(got, [brute_score(net, t) for t in texts], atol=1e-5)


def test_every_byte_of_a_long_text_counts():
    """The mean over windows moves wherever a text of many batches is changed."""
    net = small_net()
    scorer = langid.Windows(net, 32, batch=8)
    base = b"abc " * 5000
    first = scorer.score([base])
    for at in (0, 9_000, len(base) - 30):
        assert not np.array_equal(scorer.score([base[:at] + b"\xff\xfe" * 10 + base[at + 20:]]), first)


def test_gradients_equal_differences():
    net, rng = small_net(), np.random.default_rng(3)
    for a in net.arrays():
        a[...] = rng.standard_normal(a.shape) * 0.5
    net.embed[langid.PAD] = 0
    for name in ("embed", "dense", "dense_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters, net.bias = [[x.astype(np.float64) for x in xs] for xs in (net.filters, net.bias)]
    rows, labels = rng.integers(0, 6, (5, 12)), np.array([0, 1, 2, 0, 1])
    _, grads = langid.gradients(net, rows, labels)
    for a, g in zip(net.arrays(), grads):
        for _ in range(6):
            at = tuple(int(rng.integers(n)) if k or a is not net.embed else int(rng.integers(6)) for k, n in enumerate(a.shape))
            old, ends = a[at], []
            for d in (1e-5, -1e-5):
                a[at] = old + d
                ends.append(langid.gradients(net, rows, labels)[0])
            a[at] = old
            assert abs((ends[0] - ends[1]) / 2e-5 - g[at]) < 1e-4


def test_held_out_accuracy(spark):
    """Languages of the held-out documents, learned from the others only."""
    got = {r.doc_id: r for r in QUERIES["op12_language_id"](spark, SF01).collect()}
    want = {r.doc_id: r.lang for r in table(spark, SF01, "documents").collect()}
    assert got.keys() == want.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert len(held) > 150 and np.mean([got[i].lang_pred == want[i] for i in held]) >= 0.97


def test_edge_rows(spark):
    rows = [(1, "ab ab ab", "x", 1), (2, "cd cd cd", "y", 1), (2, "cd cd cd", "y", 1), (None, "ab", None, 1), (3, None, "x", 1),
            (4, "", "y", 1), (5, "12 -- 3", "y", 1), (6, "AB AB", "x", 1), (7, "é", None, 1), (8, "cd " * 9000, "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int").repartition(2)
    net = langid.fit(docs.select("text", "lang"), SMALL)
    assert net.langs == ["x", "y"]
    got = sorted(((r.id, r.lang_pred, r.score) for r in langid.predict(docs, net, p=SMALL).collect()), key=repr)
    assert len(got) == len(rows)
    und = {i for i, lang, s in got if lang == "und" and s == 0}
    assert und == {3, 4, 5} and all(s >= 0.5 for i, _, s in got if i not in und)
    assert {i: lang for i, lang, _ in got if i in (1, 2, 6, 8)} == {1: "x", 2: "y", 6: "x", 8: "y"}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "x")], "doc_id bigint, text string, lang string")
    assert langid.fit(docs.select("text", "lang"), SMALL) is None
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, None).collect()} == {("und", 0.0)}
    assert langid.predict(docs.limit(0), None).collect() == []
    with pytest.raises(ValueError):
        langid.fit(docs.select("text", "lang"), langid.NetParams(max_languages=0))


def test_copies_are_one_text_of_the_sample(spark):
    rows = [("same text", "x")] * 500 + [(f"other {i}", "x") for i in range(20)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = [r.text for r in langid.sample_texts(docs, langid.NetParams(texts_per_language=15)).collect()]
    assert len(got) == 15 == len(set(got))
