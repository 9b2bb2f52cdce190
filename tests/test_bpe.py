"""BPE mode: learned merges vs a brute-force trainer; encoding vs the tokenizer library."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tokenweave.operators import bpe, dictionary, merges, packed
from tokenweave.sources.corpus import read_corpus, table_path


def brute_force_merges(texts, merges):
    import regex

    pat = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    words = Counter(tuple(m.encode("utf-8")) for t in texts for m in pat.findall(t))
    out = []
    for r in range(merges):
        pairs = Counter()
        for w, c in words.items():
            for a, b in zip(w, w[1:]):
                pairs[(a, b)] += c
        if not pairs:
            break
        (a, b), c = min(pairs.items(), key=lambda kv: (-kv[1], kv[0]))
        new = 256 + r
        out.append((r, a, b, new, c))
        merged = Counter()
        for w, cnt in words.items():
            res, i = [], 0
            while i < len(w):
                if i + 1 < len(w) and w[i] == a and w[i + 1] == b:
                    res.append(new)
                    i += 2
                else:
                    res.append(w[i])
                    i += 1
            merged[tuple(res)] += cnt
        words = merged
    return out


@pytest.fixture(scope="module")
def small_docs(spark):
    docs = read_corpus(spark, table_path(SF001, "documents"))
    return docs.filter(F.col("doc_id") < 20)


def test_learned_merges_match_brute_force(spark, small_docs):
    got = [tuple(r) for r in merges.learn_merges(small_docs, 12).orderBy("rank").collect()]
    texts = [r.text for r in small_docs.collect()]
    assert got == brute_force_merges(texts, 12)


@pytest.mark.parametrize("batch,draft_pieces", [(64, 20_000), (16, 40), (5, 0)])
def test_batched_merges_match_brute_force(spark, small_docs, batch, draft_pieces):
    """Hundreds of merges, with a draft that sees all pieces, few or none: proposals never change what is learned."""
    got = [tuple(r) for r in merges.learn_merges(small_docs, 150 if draft_pieces else 12, batch, draft_pieces).orderBy("rank").collect()]
    assert got == brute_force_merges([r.text for r in small_docs.collect()], len(got)) and len(got) == (150 if draft_pieces else 12)


def test_merges_run_out(spark):
    docs = spark.createDataFrame([(1, "aaaa aaaa"), (2, "b")], "doc_id bigint, text string")
    got = [tuple(r) for r in merges.learn_merges(docs, 50).orderBy("rank").collect()]
    assert got == brute_force_merges(["aaaa aaaa", "b"], 50) and 0 < len(got) < 50
    assert merges.learn_merges(docs.limit(0), 5).collect() == []


def test_a_draft_takes_merges_back():
    draft = merges.Draft([([1, 2, 1, 2, 3], 5), ([2, 3], 7)])
    before, words = dict(draft.pairs), [list(w) for w in draft.words]
    draft.merge((1, 2), 9)
    assert draft.words[0] == [9, 9, 3] and draft.pairs[9, 9] == 5
    draft.back()
    assert {q: c for q, c in draft.pairs.items() if c} == before and draft.words == words


def test_proposals_are_accepted_up_to_the_first_wrong_one():
    series = {(1, 2): (10, {0: -10}), (3, 4): (8, {0: -1, 1: -7}), (2, 5): (8, {0: -2}), (9, 5): (0, {0: 7, 1: 1})}
    assert merges.accepted([(1, 2), (3, 4)], series, 1) == [10, 7]  # after the first, (3, 4) and (9, 5) have 7: the smaller pair
    assert merges.accepted([(1, 2), (9, 5)], series, 1) == [10]
    assert merges.accepted([(1, 2), (3, 4)], series, 7.5) == [10]  # below the bound nothing was compared


def test_pieces_laid_end_to_end_merge_like_one_piece():
    """Runs of one symbol, pairs beside each other and pairs across the ends of pieces."""
    import random

    rng = random.Random(3)
    words = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(200)] + [[1] * 7, [1], [1, 1]]
    for pair in [(a, b) for a in range(3) for b in range(3)]:
        line = merges.Line(sum(words, []), [len(w) for w in words])
        piece, keys, sign = line.merge(pair, 300)
        diff, after = Counter(), []
        for i, w in enumerate(words):
            out = []
            for x in w:
                out.append(x)
                if tuple(out[-2:]) == pair:
                    out[-2:] = [300]
            after.append(out)
            diff.update({(i, q): c for q, c in Counter(zip(out, out[1:])).items()})
            diff.subtract({(i, q): c for q, c in Counter(zip(w, w[1:])).items()})
        told = Counter()
        for i, k, d in zip(piece.tolist(), keys.tolist(), sign.tolist()):
            told[i, (k >> 16, k & 0xFFFF)] += d
        assert line.symbols().tolist() == sum(after, []) and line.lengths().tolist() == [len(w) for w in after]
        assert {k: d for k, d in told.items() if d} == {k: d for k, d in diff.items() if d}


def test_rounds_do_not_write_the_pieces_anew(spark, small_docs, monkeypatch):
    """30 rounds of 5 merges write the table of pieces twice: at first and when enough merges have gathered."""
    made, write = [], merges.written
    monkeypatch.setattr(merges, "written", lambda df, name: made.append(name) or write(df, name))
    got = [tuple(r) for r in merges.learn_merges(small_docs, 150, 5).orderBy("rank").collect()]
    assert got == brute_force_merges([r.text for r in small_docs.collect()], 150)
    assert made.count("pieces") == 2 and len(made) > 30


def test_few_compared_pairs_and_pieces_written_often(spark, small_docs, monkeypatch):
    """Pairs left out of the comparison, with equal counts too, and merges applied in several rewrites."""
    monkeypatch.setattr(merges, "TOP_PAIRS", 3)
    monkeypatch.setattr(merges, "REWRITE", 4)
    monkeypatch.setattr(merges, "MOST_ROWS", 10)
    got = [tuple(r) for r in merges.learn_merges(small_docs, 15).orderBy("rank").collect()]
    assert got == brute_force_merges([r.text for r in small_docs.collect()], 15)
    docs = spark.createDataFrame([(1, "ab cd ef gh ij kl"), (2, None)], "doc_id bigint, text string")
    got = [tuple(r) for r in merges.learn_merges(docs, 50).orderBy("rank").collect()]
    assert got == brute_force_merges(["ab cd ef gh ij kl"], 50)


def test_encode_matches_tokenizer_library(spark, small_docs):
    tiktoken = pytest.importorskip("tiktoken")
    learned = merges.learn_merges(small_docs, 12)
    table = bpe.merge_table(learned, 12)
    toks = bpe.token_bytes(table)
    enc = tiktoken.Encoding(
        name="learned",
        pat_str=r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
        mergeable_ranks={b: i for i, b in enumerate(toks)},
        special_tokens={"<|endoftext|>": len(toks)})
    docs = read_corpus(spark, table_path(SF001, "documents"))
    ours = {r.doc_id: list(r.ids) for r in bpe.encode_bpe(docs, learned).collect()}
    for r in docs.collect():
        assert ours[r.doc_id] == [len(toks)] + enc.encode_ordinary(r.text), r.doc_id


def test_decode_round_trip(spark, small_docs):
    learned = merges.learn_merges(small_docs, 8)
    table = bpe.merge_table(learned, 8)
    enc = bpe.encode_bpe(small_docs, learned)
    dec = {r.doc_id: r.t for r in enc.select("doc_id", bpe.decode_bpe(F.col("ids"), table).alias("t")).collect()}
    for r in small_docs.collect():
        assert dec[r.doc_id] == r.text


def test_long_pieces_merge_like_short_ones(spark, small_docs):
    table = bpe.merge_table(merges.learn_merges(small_docs, 24), 24)
    ranks = {(a, b): (r, t) for r, (a, b, t) in enumerate(table)}
    import random
    rng = random.Random(1)
    for n in (65, 200, 1000):
        data = bytes(rng.choice(b"thearni ") for _ in range(n))
        parts = list(data)
        while True:  # the rule: lowest rank first, leftmost of equals
            found = [(ranks[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
            if not found:
                break
            r, i = min(found)
            parts[i:i + 2] = [table[r][2]]
        assert bpe.bpe_word(data, ranks) == parts
    assert bpe.bpe_word(b"the " * 20_000, ranks)


@pytest.fixture(scope="module")
def rank_table():
    from tokenweave.params import RANKED, rank_path

    return bpe.load_ranks(rank_path(RANKED))


@pytest.mark.parametrize("hot_pieces", [0, 300, dictionary.HOT_PIECES])
def test_given_ranks_equal_the_tokenizer_library(spark, rank_table, hot_pieces):
    """Every document, whether its pieces come from the broadcast dictionary, the join or both."""
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    library = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    docs = read_corpus(spark, table_path(SF001, "documents"))
    # null, repeated and empty rows, special strings, a long piece
    extra = spark.createDataFrame([(900, ""), (901, "x <|endoftext|> y"), (902, "é😀 I'll  go\n\n 12345"), (None, "no key"), (None, None),
                                   (903, "twice"), (903, "twice"), (904, "ab" * 3000)], "doc_id bigint, text string")
    docs = docs.unionByName(extra)
    found = dictionary.piece_dictionary(docs, rank_table)
    rows = dictionary.encode_pieces(docs, found, len(rank_table), hot_pieces).collect()
    want = [(r.doc_id, [len(rank_table)] + library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    assert sorted(((r.doc_id, list(r.ids)) for r in rows), key=repr) == sorted(want, key=repr)
    assert all(r.n == len(r.ids) for r in rows)


def test_packed_ranks_decode_to_the_text(spark, rank_table, small_docs):
    enc = dictionary.encode_pieces(small_docs, dictionary.piece_dictionary(small_docs, rank_table), len(rank_table), 500)
    back = {r.doc_id: bytes(r.data).decode() for r in packed.decode(packed.pack(enc), rank_table).collect()}
    assert back == {r.doc_id: r.text for r in small_docs.collect()}


def test_frequent_pieces_fit_the_limit(spark):
    found = spark.createDataFrame([(f"p{i}", c, [1]) for i, c in enumerate([1] * 50 + [3] * 10 + [100] * 4)], "piece string, cnt bigint, ids array<int>")
    assert [dictionary.frequent_pieces(found, k) for k in (64, 63, 14, 13, 4, 3, 0)] == [1, 2, 2, 64, 64, 1 << 62, 1 << 62]


def test_rank_file_is_configuration(spark, monkeypatch, tmp_path):
    import sys

    from tokenweave import params

    path = str(tmp_path / "own.ranks")
    assert params.rank_path(params.PackParams(rank_file=path)) == path
    spark.conf.set(params.RANK_FILE_CONF, path + "2")
    assert params.rank_path(params.RANKED, spark) == path + "2"
    spark.conf.unset(params.RANK_FILE_CONF)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    with pytest.raises(ValueError, match="rank"):
        params.rank_path(params.RANKED, spark)
    with pytest.raises(ValueError, match="every single byte"):
        dictionary.piece_dictionary(spark.createDataFrame([], "doc_id bigint, text string"), [b"a"])


def test_encoding_kernels_cut_large_batches():
    import types

    import pyarrow as pa

    from tokenweave.operators import tokens

    rows = [["ab", " ", "abc"] * 20_000] * 20
    rb = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(rows, pa.list_(pa.string()))], names=["doc_id", "pieces"])
    value = lambda v: types.SimpleNamespace(value=v)
    for kernel in (bpe._bpe_kernel(value([(97, 98, 256)]), 257), tokens._lossless_kernel(value(["ab"]), 9, 10)):
        out = list(kernel(iter([rb])))
        assert [i for b in out for i in b.column(0).to_pylist()] == list(range(20))
        assert max(b.num_rows for b in out) <= 3  # 131,072 items at once; the rest of a row goes with it


def test_rank_encoding_is_one_narrow_pass(spark, rank_table, small_docs):
    """Pieces beyond the dictionary are encoded in place: as by the join, which is not there."""
    extra = spark.createDataFrame([(None, None), (None, "x x"), (1, ""), (1, "zq" * 500 + " zqé\n\n 77")], "doc_id bigint, text string")
    docs = small_docs.select("doc_id", "text").unionByName(extra)
    everything = dictionary.piece_dictionary(docs, rank_table)
    rows = lambda df: sorted(((r.doc_id, r.n, list(r.ids)) for r in df.collect()), key=repr)
    want = rows(dictionary.encode_pieces(docs, everything, len(rank_table)))
    for limit in (0, 5, 10_000):
        few = dictionary.piece_dictionary(docs, rank_table, limit)
        assert few.count() <= limit
        got = dictionary.encode_pieces(docs, few, len(rank_table), limit, table=rank_table)
        assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == want
