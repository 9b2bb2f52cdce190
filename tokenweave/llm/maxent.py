"""Language-model scores by a hashed, class-factored maximum-entropy model.

P(word | history) = P(class | two classes before) * P(word | class, two words before).  The most frequent words are
classes of their own; other words share classes by a hash of their ending, so unseen words have a class as well.  The
class softmax has a bias and three kinds of features of the history: the class before (bigram), the class before that
(skip) and a hash of both (trigram).

A class of several words is a binary tree of classes with ``2 ** bits`` leaves: frequent words have a leaf of their own
(the most frequent ``2 ** bits`` of the class), others one by a hash.  On the way to the leaf each turn is a softmax of
two outcomes inside its node, with a bias and hashed features of the word before (bigram), the word before that (skip)
and both (trigram).  Words that share a leaf have (c + 1) / (C + V + 1) of it, with one place for all unseen words, so
probabilities after a history add up to 1.

Passes over the data:

1. Token counts, summed in tasks and then by token.  Everything else reads these, so it grows with the corpus.
2. Documents become rows of class numbers (one byte a token), the sums over frequent tokens, and the rare tokens
   with their counts, written once.  Frequent tokens are a table of at most ``frequent`` rows (found by a histogram,
   so no task sorts the vocabulary); rare ones meet their counts in a shuffle join.
3. Class trigrams of the training rows, at most ``classes ** 3`` sums.  Gradient updates run over them as Spark jobs:
   each task returns the rows of the gradient that its contexts touch.  With ``hashed`` at ``classes ** 2`` a context
   has a trigram row of its own, which only its task sends.
4. The turns learn from every training token: a pass for the observed sums and one for each of ``word_rounds``
   updates.  A pass has as many tasks as the cluster has cores, whatever the corpus, and a task returns one sum for
   each weight that it touched; the weights are bounded by the parameters.
5. Scoring reads the class and leaf numbers: a batch is a gather from the tables, in numpy.

Defined cases: a null text counts as empty and has the end token only; a null id is a training row unless the crc of
the empty text says otherwise; repeated rows are scored each and counted each; without training rows classes and
leaves are equally likely and words have probability 1 in their leaf; an empty table gives an empty result; only the
named columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenweave.functions.common import ship_by_value
from tokenweave.llm.common import as_bytes, column, materialise, passing, pieces

ship_by_value(__name__)

END = b"\n"  # no word contains white space
HELD_TOKENS = 300_000  # distinct tokens a task holds before it passes its sums on
LONGEST_FREQUENT = 64  # bytes of a word in the table of frequent ones


@dataclass(frozen=True)
class LMParams:
    """``head`` classes of one word and ``tail`` classes by ending; ``hashed`` trigram features: as many as contexts.

    Trees of words have ``2 ** bits`` leaves and share ``2 ** word_hashed_bits`` weights for each kind of feature.
    """

    head: int = 48
    tail: int = 80
    hashed: int = 16_384
    gradient_tasks: int = 4
    frequent: int = 65_536
    rounds: int = 12
    rate: float = 0.6
    prior: float = 2.0  # counts added to both sides of an update's scale
    bits: int = 10
    word_hashed_bits: int = 17
    word_rounds: int = 3
    word_prior: float = 8.0

    @property
    def classes(self) -> int:
        return self.head + self.tail

    @property
    def leaves(self) -> int:
        return 1 << self.bits


def tokens(text: bytes) -> list[bytes]:
    words = text.lower().split()  # bytes: A-Z only, and exactly the six white-space bytes
    words.append(END)
    return words


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    train, rest = Counter(), Counter()

    def flush() -> pa.RecordBatch:
        both = train.keys() | rest.keys()
        out = pa.RecordBatch.from_pydict({
            "token": pa.array(both, pa.binary()), "c": pa.array([train[t] for t in both], pa.int64()),
            "others": pa.array([rest[t] for t in both], pa.int64())})
        train.clear()
        rest.clear()
        return out

    for b in pieces(batches, 500):
        for text, held in zip(as_bytes(column(b, "text")), column(b, "held_out").to_pylist()):
            (rest if held else train).update(tokens(text))
        if len(train) + len(rest) > HELD_TOKENS:
            yield flush()
    if train or rest:
        yield flush()


def token_counts(docs: DataFrame) -> DataFrame:
    """``token``, ``c`` (in training rows) and ``others`` (in held-out rows), written once."""
    parts = docs.mapInArrow(_counts, "token binary, c bigint, others bigint")
    return materialise(parts.groupBy("token").agg(F.sum("c").alias("c"), F.sum("others").alias("others")), "token-counts")


def tail_class(word: bytes, head: int, tail: int) -> int:
    return head + zlib.crc32(word[-2:]) % tail


def _tail_class(token: Column, p: LMParams) -> Column:
    last = F.when(F.octet_length(token) > 2, F.substring(token, -2, 2)).otherwise(token)
    return F.lit(p.head) + F.crc32(last) % F.lit(p.tail)


def leaf_number(word: bytes, p: LMParams) -> int:
    return zlib.crc32(word) % p.leaves


def frequent_tokens(counts: DataFrame, p: LMParams) -> tuple[list, Column]:
    """At most ``p.frequent`` of the most frequent tokens, with their counts, and what tells the others.

    A histogram over powers of 2 ** (1/8) gives the count at which the table is full; only tokens above it move.
    """
    level = F.floor(F.log2(F.col("c") + F.col("others")) * 8).cast("int")
    short = counts.where(F.octet_length("token") <= LONGEST_FREQUENT)
    sizes = short.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()  # at most 8 * 63 rows
    total, lowest = 0, None
    for r in sorted(sizes, key=lambda r: -r.level):
        total += r.n
        if total > p.frequent:
            break
        lowest = r.level
    if lowest is None:
        return [], F.lit(True)
    rest = (F.octet_length("token") > LONGEST_FREQUENT) | (level < lowest)
    return short.where(level >= lowest).select("token", "c").collect(), rest  # at most p.frequent rows


def _rows(table, p: LMParams):
    """Documents as class numbers, sums over frequent tokens and rare tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        where, logs, known, klass, leaf = table.value
        task, n = TaskContext.get().partitionId() << 33, 0
        memo: dict[bytes, int] = {}
        names = ["key", "id", "held_out", "n_tokens", "frequent_log", "head_log", "frequent_known", "classes", "leaves",
                 "rare", "rare_n"]
        for b in pieces(batches, 500):
            cols: list[list] = [[] for _ in names[3:]]
            for text in as_bytes(column(b, "text")):
                words = tokens(text)
                at = np.fromiter(map(where.get, words, [-1] * len(words)), np.int64, len(words))
                rare = np.flatnonzero(at < 0)
                own, place = klass[at], leaf[at]
                unknown = [words[i] for i in rare.tolist()]
                for i, w in zip(rare.tolist(), unknown):
                    end = w[-2:]
                    if end not in memo:  # at most 65,792 endings
                        memo[end] = tail_class(end, p.head, p.tail)
                    own[i], place[i] = memo[end], leaf_number(w, p)
                common = at[at >= 0]
                sums, few = logs[common], Counter(unknown)
                row = (len(words), sums.sum(), sums[klass[common] < p.head].sum(), int(known[common].sum()),
                       own.astype(np.uint8).tobytes(), place.astype("<u2").tobytes(), list(few.keys()), list(few.values()))
                for c, v in zip(cols, row):
                    c.append(v)
            m = b.num_rows
            types = [pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary()),
                     pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n, n + m) + task), column(b, "id"), column(b, "held_out"),
                 *[pa.array(c, t) for c, t in zip(cols, types)]], names=names)
            n += m
    return run


ROW_SCHEMA = ("key bigint, id bigint, held_out boolean, n_tokens bigint, frequent_log double, head_log double, "
              "frequent_known bigint, classes binary, leaves binary, rare array<binary>, rare_n array<int>")


def _trigrams(size: int):
    """Sums of class trigrams of the batches; a text starts after two end classes (number 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size ** 3, np.int64)
        for b in pieces(batches, 2000):
            codes = []
            for own in as_bytes(column(b, "classes")):
                x = np.concatenate((np.zeros(2, np.int64), np.frombuffer(own, np.uint8)))
                codes.append((x[:-2] * size + x[1:-1]) * size + x[2:])
            at, n = np.unique(np.concatenate(codes), return_counts=True)
            total[at] += n
        at = np.flatnonzero(total)
        for i in range(0, len(at), 100_000):
            part = at[i:i + 100_000]
            yield pa.RecordBatch.from_pydict({"context": pa.array((part // size).astype(np.int32)),
                                              "class": pa.array((part % size).astype(np.int32)), "n": pa.array(total[part])})
    return run


class Weights:
    """Bias and feature weights of the class softmax."""

    def __init__(self, p: LMParams) -> None:
        c = p.classes
        self.size, self.hashed = c, p.hashed
        self.parts = [np.zeros((n, c), np.float32) for n in (1, c, c, p.hashed)]

    def features(self, context: np.ndarray) -> list[np.ndarray]:
        """For each kind of feature the row that is on in each context (second class before * size + class before)."""
        own = context
        if self.hashed < self.size ** 2:
            own = (context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(self.hashed)
        return [np.zeros_like(context), context % self.size, context // self.size, own.astype(np.int64)]

    def log_probabilities(self, context: np.ndarray) -> np.ndarray:
        x = sum(w[f] for w, f in zip(self.parts, self.features(context))).astype(np.float64)
        x -= x.max(axis=1, keepdims=True)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _sums(model):
    """A task's sums over its contexts: observed feature counts if ``model`` is None, else those the model expects.

    Only rows of features that were on are sent, expected sums as 4-byte floats, observed ones as 8-byte floats.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, observed = model.value
        total = [np.zeros(w.shape) for w in weights.parts]
        on = [np.zeros(len(w), bool) for w in weights.parts]
        fit = 0.0
        for b in pieces(batches, 2048):
            context = column(b, "context").to_numpy(zero_copy_only=False).astype(np.int64)
            n = np.zeros((len(context), weights.size))
            lists = column(b, "counts")
            where = np.repeat(np.arange(len(context)), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            n[where, flat.field("class").to_numpy(zero_copy_only=False)] = flat.field("n").to_numpy(zero_copy_only=False)
            if not observed:
                logs = weights.log_probabilities(context)
                fit += float((n * logs).sum())
                n = np.exp(logs) * n.sum(axis=1, keepdims=True)
            for t, o, f in zip(total, on, weights.features(context)):
                np.add.at(t, f, n)
                o[f] = True
        at = np.flatnonzero(np.concatenate(on)).astype(np.int32)
        sums = np.concatenate([t[o] for t, o in zip(total, on)]).astype(np.float64 if observed else np.float32)
        yield pa.RecordBatch.from_pydict({"fit": [fit], "at": pa.array([at.tobytes()], pa.binary()),
                                          "sums": pa.array([sums.tobytes()], pa.binary())})
    return run


def _collect_sums(contexts: DataFrame, weights: Weights, observed: bool) -> tuple[np.ndarray, float]:
    """The sums of all tasks, a row for each feature, one task's at a time on the driver."""
    sent = contexts.sparkSession.sparkContext.broadcast((weights, observed))
    total, fit = np.zeros((sum(map(len, weights.parts)), weights.size)), 0.0
    for r in contexts.mapInArrow(_sums(sent), "fit double, at binary, sums binary").toLocalIterator():
        part = np.frombuffer(r.sums, np.float64 if observed else np.float32).reshape(-1, weights.size)
        total[np.frombuffer(r["at"], np.int32)] += part  # a task names a row once
        fit += r.fit
    sent.destroy()
    return total, fit


def train(rows: DataFrame, p: LMParams) -> tuple[Weights, list[float]]:
    """Fit the class softmax to the training rows by distributed gradient updates; also the fit of each round."""
    size = p.classes
    trigrams = (rows.where("not held_out").select("classes").mapInArrow(_trigrams(size), "context int, class int, n bigint")
                .groupBy("context", "class").agg(F.sum("n").alias("n")))
    # at most size ** 2 rows of at most size sums: bounded by the parameters, whatever the corpus
    contexts = materialise(trigrams.groupBy("context").agg(F.collect_list(F.struct("class", "n")).alias("counts"))
                           .coalesce(p.gradient_tasks), "class-trigrams")
    weights, fits = Weights(p), []
    seen, _ = _collect_sums(contexts, weights, observed=True)
    if not seen.any():
        return weights, fits
    for step in range(p.rounds):
        due, fit = _collect_sums(contexts, weights, observed=False)
        fits.append(fit)
        # a gradient step on every weight, in units of its counts; the bias alone in the first round
        at = 0
        for i, w in enumerate(weights.parts):
            s, d = (x[at:at + len(w)] for x in (seen, due))
            at += len(w)
            if step == 0 and i == 0:
                w += np.log((s + 0.5) / (d + 0.5))
            elif step:
                w += p.rate * 2 * (s - d) / (s + d + 2 * p.prior)
    return weights, fits


TOKENS_AT_ONCE = 16_384
LARGEST = 8.0  # of a hashed weight, so that exponentials stay in range
WEIGHTS_SENT = 65_536


class WordWeights:
    """Bias and feature weights of the turns on the way to a word's leaf: for the second outcome against the first."""

    def __init__(self, p: LMParams) -> None:
        self.head, self.bits, self.hashed_bits = p.head, p.bits, p.word_hashed_bits
        # a bias for each node, hashed weights of bigram, skip and trigram features
        self.parts = [np.zeros(n, np.float32) for n in (p.classes << p.bits, *[1 << p.word_hashed_bits] * 3)]

    def words(self, classes: list[bytes], leaves: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Texts end to end, two end classes before each: class and leaf in one number, and the places of words in trees."""
        klass = np.frombuffer(b"".join(b"\0\0" + t for t in classes), np.uint8).astype(np.int64)
        leaf = np.frombuffer(b"".join(b"\0\0\0\0" + t for t in leaves), "<u2")
        return klass << self.bits | leaf, np.flatnonzero(klass >= self.head)

    def features(self, word: np.ndarray, before: np.ndarray, skip: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """For each kind of feature the weight that is on at each turn of each word, and the turns taken."""
        depth = np.arange(self.bits)
        leaf = np.arange(1 << self.bits)[:, None]
        own, turns = (1 << depth) + (leaf >> self.bits - depth), leaf >> self.bits - 1 - depth & 1  # of every leaf
        leaf = word & (1 << self.bits) - 1
        node = own.take(leaf, axis=0)
        node += (word - leaf)[:, None]
        at, mixed = [node], node.astype(np.uint32)
        mixed *= np.uint32(0x85EBCA6B)
        for kind, history in enumerate((before, skip, before << 24 | skip), 1):
            h = (history << 3 | kind).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            x = mixed ^ (h >> np.uint64(32)).astype(np.uint32)[:, None]
            x *= np.uint32(0xC2B2AE35)
            x >>= np.uint32(32 - self.hashed_bits)
            at.append(x.astype(np.int64))
        return at, turns.astype(np.float32).take(leaf, axis=0)

    def scores(self, at: list[np.ndarray]) -> np.ndarray:
        """Of the second outcome of each turn, against the first."""
        x = self.parts[0].take(at[0])
        for w, a in zip(self.parts[1:], at[1:]):
            x += w.take(a)
        return x

    def log_probabilities(self, word: np.ndarray, before: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Of each word's leaf in its class."""
        at, turn = self.features(word, before, skip)
        x = self.scores(at)
        x *= 1 - 2 * turn
        np.exp(x, out=x)
        x += 1
        return -np.log(x.prod(axis=1, dtype=np.float64))


def _word_sums(model):
    """A task's sums over its training words.

    Observed: how often each weight was on and how often with the second outcome.  Otherwise: how often the weights
    expect the second outcome.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, observed = model.value
        names = ["on", "second"] if observed else ["second"]
        total, fit = {n: [np.zeros(len(w)) for w in weights.parts] for n in names}, 0.0
        for b in pieces(batches, 500):
            word, places = weights.words(as_bytes(column(b, "classes")), as_bytes(column(b, "leaves")))
            for i in range(0, len(places), TOKENS_AT_ONCE):
                x = places[i:i + TOKENS_AT_ONCE]
                at, turn = weights.features(word[x], word[x - 1], word[x - 2])
                if observed:
                    second = turn.ravel()
                    for t, a in zip(total["on"], at):
                        t += np.bincount(a.ravel(), minlength=len(t))
                else:
                    second = np.exp(-weights.scores(at))
                    second += 1
                    np.reciprocal(second, out=second)
                    fit += float(np.log(np.maximum(np.abs(1 - turn - second), 1e-30).prod(axis=1, dtype=np.float64)).sum())
                    second = second.ravel()
                for t, a in zip(total["second"], at):
                    t += np.bincount(a.ravel(), second, len(t))
        sums = {n: np.concatenate(t) for n, t in total.items()}
        at = np.flatnonzero(np.any(list(sums.values()), axis=0)).astype(np.int32)
        for i in range(0, max(1, len(at)), WEIGHTS_SENT):
            part = at[i:i + WEIGHTS_SENT]
            yield pa.RecordBatch.from_pydict({
                "fit": [fit if i == 0 else 0.0], "at": pa.array([part.tobytes()], pa.binary()),
                **{n: pa.array([s[part].astype(np.float32).tobytes()], pa.binary()) for n, s in sums.items()}})
    return run


def _collect_word_sums(rows: DataFrame, weights: WordWeights, observed: bool) -> tuple[list[np.ndarray], float]:
    """The sums of all tasks, written by one job and added up on the driver, a part of one task's at a time."""
    sent = rows.sparkSession.sparkContext.broadcast((weights, observed))
    names = ["on", "second"] if observed else ["second"]
    total, fit = [np.zeros(sum(map(len, weights.parts))) for _ in names], 0.0
    schema = ", ".join(["fit double, at binary", *(f"{n} binary" for n in names)])
    with passing(rows.mapInArrow(_word_sums(sent), schema), "word-sums") as sums:
        for r in sums.toLocalIterator():
            for t, n in zip(total, names):
                t[np.frombuffer(r["at"], np.int32)] += np.frombuffer(r[n], np.float32)  # a task names a weight once
            fit += r.fit
    sent.destroy()
    return total, fit


def train_words(rows: DataFrame, p: LMParams) -> tuple[WordWeights, list[float]]:
    """Fit the trees to all words of the training rows by distributed gradient updates; also the fit before each."""
    weights, fits = WordWeights(p), []
    own = rows.where("not held_out").select("classes", "leaves").coalesce(max(p.gradient_tasks, rows.sparkSession.sparkContext.defaultParallelism))
    (on, seen), _ = _collect_word_sums(own, weights, observed=True)
    if not on.any():
        return weights, fits
    starts = np.cumsum([0, *map(len, weights.parts)])
    nodes = slice(0, starts[1])
    weights.parts[0][:] = np.log((seen[nodes] + 0.5) / (on[nodes] - seen[nodes] + 0.5))  # without features the fit is in closed form
    for _ in range(p.word_rounds):
        (due,), fit = _collect_word_sums(own, weights, observed=False)
        fits.append(fit)
        # a gradient step for each outcome, in units of its counts
        step = p.rate * 2 * (seen - due) * (1 / (seen + due + 2 * p.word_prior) + 1 / (2 * on - seen - due + 2 * p.word_prior))
        for i, w in enumerate(weights.parts):
            w += step[starts[i]:starts[i + 1]]
            np.clip(w, *((-LARGEST, LARGEST) if i else (-3 * LARGEST, 3 * LARGEST)), out=w)
    return weights, fits


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, size, norms, weights = model.value
        for b in pieces(batches, 500):
            texts = as_bytes(column(b, "classes"))
            word, places = weights.words(texts, as_bytes(column(b, "leaves")))
            x = word >> weights.bits
            ends = np.cumsum([len(t) + 2 for t in texts])
            starts = ends - [len(t) for t in texts]
            value = np.zeros(len(x))
            value[2:] = logs[x[:-2] * size + x[1:-1], x[2:]] - norms[word[2:]]
            for i in range(0, len(places), TOKENS_AT_ONCE):
                at = places[i:i + TOKENS_AT_ONCE]
                value[at] += weights.log_probabilities(word[at], word[at - 1], word[at - 2]) / np.log(10)
            total = np.array([value[a:z].sum() for a, z in zip(starts, ends)])
            yield pa.RecordBatch.from_arrays([column(b, "key"), pa.array(total)], names=["key", "class_log"])
    return run


def score_texts(docs: DataFrame, held_out: Column, p: LMParams = LMParams(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``base_score`` is the log10 probability under single-token counts with one added, ``score`` the model's;
    both are learned from the rows for which ``held_out`` is false.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    counts = token_counts(rows)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).collect()[0]
    table, others = frequent_tokens(counts, p)
    table.sort(key=lambda r: (-r.c, bytes(r.token)))
    words = [bytes(r.token) for r in table]
    head = [END, *[w for w in words if w != END]][:p.head]
    number = {w: i for i, w in enumerate(head)}
    klass = np.array([number.get(w, -1) for w in words], np.int64)
    leaf, placed = np.zeros(len(words), np.int64), Counter()
    for i in np.flatnonzero(klass < 0).tolist():
        klass[i] = tail_class(words[i], p.head, p.tail)
        leaf[i] = placed[klass[i]] % p.leaves  # frequent ones first, each in a leaf of its own while there are any
        placed[klass[i]] += 1
    c = np.array([r.c for r in table], np.float64)
    # the entry after the last is the one that -1 points to
    lookup = spark.sparkContext.broadcast(({w: i for i, w in enumerate(words)}, np.append(np.log10(c + 1), 0),
                                           np.append(c > 0, False), np.append(klass, 0), np.append(leaf, 0)))
    coded = materialise(rows.mapInArrow(_rows(lookup, p), ROW_SCHEMA), "lm-rows")

    # tokens and distinct tokens of every leaf in training; at most classes * leaves rows
    members = np.zeros(p.classes * p.leaves)
    np.add.at(members, klass * p.leaves + leaf, np.where((klass >= p.head) & (c > 0), c + 1, 0))
    for r in (counts.where(others & (F.col("c") > 0))
              .groupBy(_tail_class(F.col("token"), p).alias("class"), (F.crc32("token") % F.lit(p.leaves)).alias("leaf"))
              .agg((F.sum("c") + F.count("*")).alias("n")).collect()):
        members[r["class"] * p.leaves + r["leaf"]] += r.n
    norms = np.log10(members + 1)
    weights, _ = train(coded, p)
    word_weights, _ = train_words(coded, p)
    logs = np.concatenate([weights.log_probabilities(x) for x in np.split(np.arange(p.classes ** 2), p.classes)]) / np.log(10)
    model = spark.sparkContext.broadcast((logs.astype(np.float32), p.classes, norms, word_weights))
    classes = coded.select("key", "classes", "leaves").mapInArrow(_score(model), "key bigint, class_log double")

    rare = (coded.select("key", F.explode(F.arrays_zip("rare", "rare_n")).alias("r"))
            .select("key", F.col("r.rare").alias("token"), F.col("r.rare_n").alias("k"))
            .join(counts.where("c > 0").select("token", "c"), "token")
            .groupBy("key").agg(F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("rare_log"), F.sum("k").alias("rare_known")))
    out = coded.drop("classes", "leaves", "rare", "rare_n").join(classes, "key").join(rare, "key", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("frequent_known") + F.coalesce("rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("frequent_log") + rare_log - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        (F.col("class_log") + F.col("frequent_log") - F.col("head_log") + rare_log).alias("score"))
