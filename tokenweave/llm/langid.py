"""Language of a text by a byte convolutional network.

Bytes (A-Z lower-cased) are embedded; filters of several widths slide over a window of fixed length, each filter keeps its
largest response, and a softmax over the kept responses gives the window's probabilities.  A text is cut into windows that
overlap by the widest filter less one byte, so every filter sees every place of the whole text; its score is the mean of
the windows' probabilities, weighted by the bytes each window is the first to hold.

Learning: plain numpy on the driver, from a bounded sample of labelled texts: of each language the ``texts_per_language``
distinct texts with the smallest hashes, a piece of each, cropped at random places and lengths in every round.  Everything
is seeded, so the same rows give the same network.  The network is some hundred kilobytes and goes with the tasks.
Prediction folds embedding and filters into one table a filter column, so a filter response is a sum of table rows.

Scale: the sample is chosen by distinct hashes (partial sums in the map tasks) and ranks of which each task sends only
its own first ones; prediction is one narrow pass in batches of windows, so memory does not grow with a text's length.

Defined cases: a null text, or one without any letter, is ``und`` with score 0; rows without a language are not learned
from; copies of a text are one text of the sample; if nothing can be learned from, every row is ``und``; an empty table
gives an empty result; over ``max_languages`` languages raise; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenweave.functions.common import bounded_collect, ship_by_value
from tokenweave.llm.common import as_bytes, column, materialise, pieces

ship_by_value(__name__)

UNKNOWN = "und"  # fixed value
LETTER = r"\p{L}"
PAD = 256


@dataclass(frozen=True)
class NetParams:
    """``texts_per_language`` bounds the sample, ``piece`` the characters taken of each of its texts."""

    texts_per_language: int = 1500
    max_languages: int = 256
    piece: int = 512
    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4, 5)
    filters: int = 16
    embedding: int = 8
    batch: int = 64
    steps: int = 900
    rate: float = 4e-3
    seed: int = 12


@dataclass
class Net:
    langs: list[str]
    embed: np.ndarray  # (257, embedding), padding is zero
    filters: list[np.ndarray]  # by width: (width, embedding, filters)
    bias: list[np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.dense, self.dense_bias]


def new_net(langs: list[str], p: NetParams) -> Net:
    rng = np.random.default_rng(p.seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    embed = draw(PAD + 1, p.embedding, scale=0.5)
    embed[PAD] = 0
    features = len(p.widths) * p.filters
    return Net(langs, embed, [draw(w, p.embedding, p.filters, scale=(2 / (w * p.embedding)) ** 0.5) for w in p.widths],
               [np.zeros(p.filters, np.float32) for _ in p.widths], draw(features, len(langs), scale=features ** -0.5),
               np.zeros(len(langs), np.float32))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(net: Net, rows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of byte windows ``rows`` and its gradients, in the order of ``Net.arrays``."""
    n, length = rows.shape
    x = net.embed[rows]
    best, pooled = [], []
    for w, b in zip(net.filters, net.bias):
        span = length - len(w) + 1
        z = sum(x[:, j:j + span] @ w[j] for j in range(len(w)))
        at = z.argmax(axis=1)
        best.append(at)
        pooled.append(np.take_along_axis(z, at[:, None], axis=1)[:, 0] + b)
    kept = np.maximum(np.concatenate(pooled, axis=1), 0)
    prob = softmax(kept @ net.dense + net.dense_bias)
    loss = -float(np.log(prob[np.arange(n), labels] + 1e-12).mean())
    d_out = prob
    d_out[np.arange(n), labels] -= 1
    d_out /= n
    d_kept = (d_out @ net.dense.T) * (kept > 0)
    d_x, d_filters, d_bias, at_row = np.zeros_like(x), [], [], np.arange(n)[:, None]
    for i, w in enumerate(net.filters):
        own = d_kept[:, i * w.shape[2]:(i + 1) * w.shape[2]]
        d_w = np.empty_like(w)
        for j in range(len(w)):
            d_w[j] = np.einsum("nf,nfe->ef", own, x[at_row, best[i] + j])
            np.add.at(d_x, (at_row, best[i] + j), own[:, :, None] * w[j].T)
        d_filters.append(d_w)
        d_bias.append(own.sum(axis=0))
    d_embed = np.zeros_like(net.embed)
    np.add.at(d_embed, rows, d_x)
    d_embed[PAD] = 0
    return loss, [d_embed, *d_filters, *d_bias, kept.T @ d_out, d_out.sum(axis=0)]


def train(texts: list[bytes], labels: list[int], langs: list[str], p: NetParams = NetParams()) -> Net:
    """Adam over random crops; languages are drawn evenly."""
    net, rng = new_net(langs, p), np.random.default_rng(p.seed + 1)
    by_lang = [np.flatnonzero(np.array(labels) == k) for k in range(len(langs))]
    first, second = [np.zeros_like(a) for a in net.arrays()], [np.zeros_like(a) for a in net.arrays()]
    low = max(p.widths)
    for step in range(1, p.steps + 1):
        length = int(rng.choice([16, 32, 64, 128, p.window]))
        rows, want = np.full((p.batch, max(length, low)), PAD), rng.integers(len(langs), size=p.batch)
        for r, k in enumerate(want):
            text = texts[rng.choice(by_lang[k])]
            at = int(rng.integers(max(1, len(text) - length + 1)))
            crop = np.frombuffer(text[at:at + length], np.uint8)
            rows[r, :len(crop)] = crop
        _, grads = gradients(net, rows, want)
        rate = p.rate * (1 - (step - 1) / p.steps)
        for a, g, m, v in zip(net.arrays(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def sample_texts(docs: DataFrame, p: NetParams) -> DataFrame:
    """``lang``, ``text`` (a piece) of the bounded sample of ``docs`` (``text``, ``lang``)."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER)).select("lang", "text", F.xxhash64("text").alias("h"))
    first = Window.partitionBy("lang").orderBy("h")
    chosen = rows.select("lang", "h").distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= p.texts_per_language)
    chosen = materialise(chosen.select("lang", "h"), "langid-sample")
    start = F.expr(f"cast(pmod(h, greatest(1, length(text) - {p.piece} + 1)) as int) + 1")
    return (rows.join(F.broadcast(chosen), ["lang", "h"])  # at most max_languages * texts_per_language rows
            .groupBy("lang", "h").agg(F.min(F.substring(F.col("text"), start, F.lit(p.piece))).alias("text")))


def fit(docs: DataFrame, p: NetParams = NetParams()) -> Net | None:
    """The network learned from rows of ``docs`` (``text``, ``lang``); None if no row can be learned from."""
    langs = [r[0] for r in bounded_collect(docs.where("lang IS NOT NULL").select("lang").distinct(), p.max_languages, "languages")]
    rows = bounded_collect(sample_texts(docs, p), p.texts_per_language * max(1, len(langs)), "language sample")
    rows = sorted((r["lang"], r["text"]) for r in rows)
    if not rows:
        return None
    langs = sorted({lang for lang, _ in rows})
    place = {lang: k for k, lang in enumerate(langs)}
    return train([t.encode().lower() for _, t in rows], [place[lang] for lang, _ in rows], langs, p)


class Windows:
    """Cuts texts into windows and scores them a batch at a time."""

    def __init__(self, net: Net, window: int, batch: int = 64):
        self.window, self.batch = window, batch
        self.overlap = max(map(len, net.filters)) - 1
        # the response of a filter column to each byte value
        self.tables = [[np.ascontiguousarray(net.embed @ w[j]) for j in range(len(w))] for w in net.filters]
        self.net = net
        self.buffers = [np.empty(window * batch * net.filters[0].shape[2], np.float32) for _ in range(2)]

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Of windows laid out (place, window), so that the largest response is taken over whole rows."""
        length, n = rows.shape
        kept = []
        for tables, b in zip(self.tables, self.net.bias):
            span = length - len(tables) + 1
            # buffers are reused: fresh ones of this size would be new pages every time
            z, one = (x[:span * n * len(b)].reshape(span, n, len(b)) for x in self.buffers)
            np.take(tables[0], rows[:span], axis=0, out=z, mode="clip")
            for j in range(1, len(tables)):
                np.take(tables[j], rows[j:j + span], axis=0, out=one, mode="clip")
                z += one
            kept.append(z.max(axis=0) + b)
        return softmax(np.maximum(np.concatenate(kept, axis=1), 0) @ self.net.dense + self.net.dense_bias)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Weighted mean of the windows' probabilities of each text."""
        step = self.window - self.overlap
        out, held, room = np.zeros((len(texts), len(self.net.langs))), [], self.batch
        rows = np.full((self.batch, self.window), PAD, np.int64)

        def flush():
            prob = self.probabilities(np.ascontiguousarray(rows[:len(held)].T))
            for (t, weight), q in zip(held, prob):
                out[t] += weight * q
            rows[:] = PAD
            held.clear()

        for t, text in enumerate(texts):
            text = text.lower()
            for at in range(0, max(1, len(text) - self.overlap), step):
                part = np.frombuffer(text, np.uint8, min(self.window, len(text) - at), at)
                rows[len(held), :len(part)] = part
                held.append((t, max(1, min(step, len(text) - at))))
                if len(held) == room:
                    flush()
        if held:
            flush()
        return out / out.sum(axis=1, keepdims=True)


def _predict(net: Net | None, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = net and Windows(net, window)
        for b in pieces(batches, 1000):
            known = column(b, "letters").to_numpy(zero_copy_only=False).astype(bool) & (net is not None)
            langs, score = np.full(len(known), UNKNOWN, object), np.zeros(len(known))
            if known.any():
                prob = scorer.score([t for t, k in zip(as_bytes(column(b, "text")), known) if k])
                langs[known] = np.array(net.langs, object)[prob.argmax(axis=1)]
                score[known] = prob.max(axis=1).clip(0, 1)
            yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(langs, pa.string()), pa.array(score)], names=["id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text", p: NetParams = NetParams()) -> DataFrame:
    """``id``, ``lang_pred`` and ``score`` (its probability) of every row."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(text_col).rlike(LETTER), F.lit(False)).alias("letters"))
    return rows.mapInArrow(_predict(net, p.window), "id bigint, lang_pred string, score double")
