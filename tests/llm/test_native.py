"""Personal data, chat formatting and mixing on small fixtures, against plain Python."""

import re
import time
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from tokenweave.llm import chat, curriculum, pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
CHECK = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
         "card": lambda s: 14 <= len(re.sub(r"\D", "", s)) <= 19 and luhn(re.sub(r"\D", "", s)),
         "phone": lambda s: 10 <= len(re.sub(r"\D", "", s)) <= 15}


def base_spans(text):
    out = [(m.start(), k, m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text, re.A) if CHECK[k](m.group())]
    return sorted(out, key=lambda s: (s[0], list(PLAIN).index(s[1])))


TEXTS = [
    None, "", "plain text é without", "a@b.c_x@y.z. and a@b.c@d.e, x..y%z@h-1.co.uk!", "é😀 me@mail.example.com",
    "999.1.2.3.4 1.2.3.4.5.6.7.8 0255.001.0.9 256.1.1.1 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111111 5 4111111111111111",
    "5 4111 1111 1111 1111", "+1 (171) 555-2028. +123 +1((((((( +49 30 1234567890123 +1 2 3 4 5 6 7 8 9 0-", "7536784127813050 4845168114407329",
    "1" * 20000, "a" * 20000 + "@x.y" + ".z" * 3000, "1 " * 5000, "+1" + "(" * 20000, "1.2.3.4 " * 500, "4111111111111111 " * 50,
]


def test_base_kinds_equal_plain_patterns(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for r in got:
        spans = [(s.start, s.kind, s.end) for s in r.pii if s.kind in pii.BASE]
        assert spans == base_spans(TEXTS[r.doc_id] or ""), r.doc_id


def test_checksums_and_context(spark):
    texts = ["pay to GB82 WEST 1234 5698 7654 32 now", "DE89370400440532013000", "DE89370400440532013001",
             "my ssn is 123-45-6789", "code 123-45-6789", "card 4111111111111111"]
    rows = pii.find_pii(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")).orderBy("doc_id").collect()
    kinds = [[s.kind for s in r.pii] for r in rows]
    assert kinds[0] == ["iban"] and kinds[1] == ["card", "iban"] or kinds[1] == ["iban"]
    assert "iban" not in kinds[2] and kinds[3] == ["ssn"] and kinds[4] == []
    assert rows[5].pii[0].score == pytest.approx(1.0)


def test_redaction(spark):
    rows = [(1, "mail me@x.org, +1 (171) 555-2028 or 4111 1111 1111 1111.", "k"), (2, None, None), (3, "nothing", "k"),
            (4, "+4111111111111111", "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, PII string")
    out = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert out == {1: "mail [EMAIL], [PHONE] or [CARD].", 2: None, 3: "nothing", 4: "+[CARD]"}
    assert pii.find_pii(df.limit(0)).collect() == []


def test_redaction_of_overlapping_spans(spark):
    text = "+41 11 111 111 11 1111 x"  # the phone holds a card
    row = pii.redact(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()[0]
    spans = base_spans(text)
    gone = {i for a, _, z in spans for i in range(a, z)}
    assert re.sub(r"\[[A-Z]+\]", "", row.text) == "".join(c for i, c in enumerate(text) if i not in gone)


CHATS = [
    (1, 1, "assistant", "b<|end|>"), (1, 0, "user", "a[INST]"), (1, 2, "assistant", "c\\<\\[ <\\ [\\"), (2, None, None, None),
    (2, 0, "<|turn|>x|", "</s>"), (None, 0, "assistant", "é😀\n"), (3, 5, "user", "u"), (3, 5, "user", "u"), (3, 6, "", ""),
    (4, 0, "assistant", ""), (4, 1, "user", "<|next|><|text|>"), (4, 2, "user", ""),
]


def test_chats_read_back(spark):
    df = spark.createDataFrame([(*r, 1) for r in CHATS], "conv_id bigint, turn bigint, role string, text string, formatted int").repartition(3)
    out = chat.read_chats(chat.format_chats(df)).withColumn("loss", chat.loss_mask(F.col("formatted"))).collect()
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in CHATS}:
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in CHATS if r[0] == conv), key=key)]
        row = next(r for r in out if r.conv_id == conv)
        assert [tuple(t) for t in row.turns] == want
        assert row.loss == [t for role, t in want if role == "assistant"]
        body = re.sub(r"<\|(turn|text|next|end)\|>", "", row.formatted)
        assert "[INST]" not in row.formatted and "</s>" not in row.formatted and "<|" not in body
        merged = sum(i == 0 or a[0] != want[i - 1][0] for i, a in enumerate(want))
        assert row.formatted.count(chat.TURN) == merged == row.formatted.count(chat.END)
    assert chat.format_chats(df.limit(0)).collect() == []


def test_long_conversation(spark):
    df = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 3 = 0, 'user', 'assistant') AS role", "cast(id AS string) AS text")
    row = chat.read_chats(chat.format_chats(df)).collect()[0]
    assert [t.text for t in row.turns] == [str(i) for i in range(20_000)]


def test_reshare():
    assert curriculum.reshare([10, 10, 10], [1, 2, 3], 3) == [5, 10, 15]
    assert curriculum.reshare([100, 1, 1], [1, 2, 3], 3) == [96, 3, 3]
    assert curriculum.reshare([0, 0], [1, 2], 3) == [0, 0] and curriculum.reshare([], [], 3) == []
    sizes, weights = [5, 50, 500, 7], [1, 2, 3, 1]
    targets = curriculum.reshare(sizes, weights, 3)
    assert sum(targets) == sum(sizes) and all(t <= 3 * n for t, n in zip(targets, sizes))
    free = {Fraction(t, w) for t, n, w in zip(targets, sizes, weights) if t < 3 * n}
    assert len(free) == 1  # the others share by weight


def test_mix_meets_targets(spark):
    import random
    rng = random.Random(3)
    rows = [(i if i % 17 else None, " ".join(["w"] * rng.randint(0, 30)) if i % 11 else None,
             rng.choice(["a", "a", "a", "b", "ü", None]), 5, "z") for i in range(400)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, taken int, Size string").repartition(4)
    out = curriculum.training_order(curriculum.mix(df)).collect()
    again = curriculum.mix(df.repartition(7)).collect()
    key = lambda r: str((r.doc_id, r.text, r.source, r.taken, r.first_position))
    assert sorted(map(key, out)) == sorted(map(key, again))
    assert len(out) == len(rows)
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(len((r[1] or "").split()) for r in rows if r[2] == n) for n in names]
    targets = curriculum.reshare(sizes, [1 + i % 3 for i in range(len(names))], 3)
    for n, size, target in zip(names, sizes, targets):
        own = [r for r in out if r.source == n]
        assert sum(r.taken for r in own) == int(target) and {r.source_size for r in own} == {size}
    assert all(0 <= r.taken <= 3 * r.size for r in out)
    placed = [r.first_position for r in out if r.first_position is not None]
    assert placed == sorted(placed) and 0 <= min(placed) and max(r.last_position or 0 for r in out) < 1
    assert curriculum.mix(df.limit(0)).collect() == []


def test_position_inverts_the_demand(spark):
    for d in (-1.0, -0.5, 0.0, 0.5, 1.0):
        for x in (0.0, 0.1, 0.5, 0.9, 1.0):
            t = spark.range(1).select(curriculum.position(F.lit(100 * x), F.lit(100.0), F.lit(d)).alias("t")).collect()[0].t
            assert abs((1 - d) * t + d * t * t - x) < 1e-9




@pytest.mark.parametrize("word,kind", [("é a@b.co ", "email"), ("10.0.0.1 x ", "ip")])
def test_forty_thousand_spans_in_one_text(spark, word, kind):
    n = 40_000
    df = spark.createDataFrame([(1, word * n), (2, word)], "doc_id bigint, text string")
    pii.find_pii(df.where("doc_id = 2")).collect()  # the plan's code is compiled
    begin = time.monotonic()
    row = pii.find_pii(df.where("doc_id = 1")).select(F.size("pii").alias("n"), F.col("pii")[n - 1]["start"].alias("last")).first()
    assert (row.n, row["last"]) == (n, len(word) * (n - 1) + re.search(r"[a0-9]", word).start())
    assert pii.redact(df.where("doc_id = 1")).first().text == re.sub(r"a@b\.co|10\.0\.0\.1", f"[{kind.upper()}]", word) * n
    assert time.monotonic() - begin < 15  # appending to one array took a minute for either


def test_redaction_across_blocks_of_a_text(spark, monkeypatch):
    monkeypatch.setattr(pii, "TEXT_BLOCK", 7)
    monkeypatch.setattr(pii, "BLOCK", 2)
    text = "😀é write to me@mail.example.com or\n+1 (171) 555-2028, 1.2.3.4 " * 5 + "end"
    row = pii.redact(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row.text == "😀é write to [EMAIL] or\n[PHONE], [IP] " * 5 + "end"


def test_rows_without_an_id_are_spread_over_the_buckets(spark):
    df = spark.range(2000).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"),
                                  F.lit("a").alias("source"))
    out = curriculum.mix(df).collect()
    assert sum(r.taken for r in out) == 4000
    assert len({r.first_position for r in out}) == 2000  # every row has its own place in the source
    key = F.substring(F.md5("text"), 1, 3)
    assert df.groupBy(key).count().agg(F.max("count")).first()[0] < 20  # its buckets
