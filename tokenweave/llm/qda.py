"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Every text becomes ``FEATURES`` transformed statistics (sizes, character classes, words, lines).  Each class has a
mean and a covariance, shrunk towards the pooled covariance and its diagonal; a text's score is the difference of
the classes' log densities, computed from Mahalanobis distances with the Cholesky factors kept in the model, put
through a logistic curve fitted to the training rows.

The moments (count, sum, sum of products) are all the fit needs, so it reads every labelled row: tasks return
partial sums of fixed size.  The curve is fitted to a histogram of ``BINS`` bins.  The texts are read once.

Defined cases: a null or empty text has statistics 0 and gets a score like any other; rows without a label, or
with a label other than 0 and 1, teach nothing; a document with several labels counts with the smallest; a null id is
never taught; if a class has no training row every score is 1 or 0 (1 if none has: nothing to reject); repeated rows are scored
each; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenweave.functions.common import ship_by_value
from tokenweave.llm.common import as_bytes, column, materialise

ship_by_value(__name__)

FEATURES = ("log_bytes", "log_words", "word_length", "word_spread", "longest_word", "new_words", "top_word", "short_words",
            "upper", "digits", "symbols", "bangs", "bars", "stops", "commas", "lines", "line_length", "repeated_lines",
            "beyond_ascii", "entropy", "symbol_words", "upper_words")
_SYMBOL = np.array([c in b"#$%&*+/<=>@[\\]^_`{}~" for c in range(256)])
BINS, BIN_LIMIT = 400, 40.0
CLIP = 8.0  # standard deviations
RIDGE = 3e-3  # least variance of a standardised statistic
SHORT = 10  # words at which a deviation counts by the root of a half


def statistics(text: bytes) -> np.ndarray:
    """The transformed statistics of one text."""
    out = np.zeros(len(FEATURES))
    words = text.split()
    if not words:
        return out
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, k = len(text), len(words)
    sizes = np.fromiter(map(len, words), np.int64, k)
    lines = [x for x in text.split(b"\n") if x]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    letters = max(1, int(hist[65:91].sum() + hist[97:123].sum()))
    part = hist[hist > 0] / n
    ends = np.cumsum(sizes)  # words without their separators, end to end
    joined = np.frombuffer(b"".join(words), np.uint8)
    marks = np.concatenate(([0], np.cumsum(_SYMBOL[joined] | (joined == 33) | (joined == 124))))
    capital = np.concatenate(([0], np.cumsum((joined >= 65) & (joined <= 90))))
    per = lambda c: c[ends] - c[ends - sizes]
    out[:] = (np.log1p(n), np.log1p(k), np.log(sizes.mean()), np.log1p(sizes.std()), np.log(sizes.max()),
              len(counts) / k ** 0.9, np.sqrt(max(counts.values()) / k), np.sqrt((sizes <= 3).mean()),
              np.sqrt(hist[65:91].sum() / letters), np.sqrt(hist[48:58].sum() / n), np.sqrt(hist[_SYMBOL].sum() / n),
              np.sqrt(hist[33] / k), np.sqrt(hist[124] / k), np.sqrt((hist[46] + hist[63]) / k), np.sqrt(hist[44] / k),
              np.log1p(len(lines)), np.log1p(n / max(1, len(lines))), np.sqrt(1 - len(set(lines)) / max(1, len(lines))),
              np.sqrt(hist[128:].sum() / n), -(part * np.log(part)).sum(), np.sqrt((per(marks) > 0).mean()),
              np.sqrt((per(capital) >= 2).mean()))
    return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [statistics(t) for t in as_bytes(column(b, "text"))]
        x = np.array(rows).reshape(-1, len(FEATURES))
        values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([column(b, "id"), values], names=["id", "x"])


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return column(b, "x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(FEATURES)
    n, s, q = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for b in batches:
        x, y = _matrix(b), column(b, "y").to_numpy(zero_copy_only=False)
        for c in (0, 1):
            own = x[y == c]
            n[c] += len(own)
            s[c] += own.sum(axis=0)
            q[c] += own.T @ own
    for c in (0, 1):
        if n[c]:
            yield pa.RecordBatch.from_pydict({"y": pa.array([c], pa.int32()), "n": [float(n[c])], "s": [s[c].tolist()],
                                              "q": [q[c].ravel().tolist()]})


@dataclass(frozen=True)
class Model:
    """Class densities by cached Cholesky factors, and the logistic curve of the score."""

    mean: np.ndarray  # of all classes, for standardising
    scale: np.ndarray
    centres: np.ndarray
    inverse_factors: np.ndarray  # L^-1 of each class covariance L L'
    log_dets: np.ndarray
    log_prior: float
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, priors included."""
        words = np.expm1(x[:, FEATURES.index("log_words")])
        # statistics of few words vary more, so they stand nearer to the mean
        trust = np.sqrt(words / (words + SHORT))[:, None]
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP) * trust
        logs = [-0.5 * (((z - m) @ li.T) ** 2).sum(axis=1) - 0.5 * d
                for m, li, d in zip(self.centres, self.inverse_factors, self.log_dets)]
        return logs[1] - logs[0] + self.log_prior

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.shift, -700, 700)))


def densities(n: np.ndarray, s: np.ndarray, q: np.ndarray, pooled_share: float, diagonal_share: float) -> Model:
    """The model of class counts, sums and sums of products (the curve is still the identity)."""
    d = len(FEATURES)
    if not n.all():
        return Model(*[np.zeros(1)] * 5, 0.0, constant=float(n[1] > 0 or not n.any()))
    centre = s / n[:, None]
    cov = q / n[:, None, None] - centre[:, :, None] * centre[:, None, :]
    pooled = (cov * n[:, None, None]).sum(axis=0) / n.sum()
    mean = s.sum(axis=0) / n.sum()
    # spread over all rows: one within classes would be 0 for a statistic that tells the classes apart exactly
    scale = np.sqrt(np.maximum(np.diag(q.sum(axis=0)) / n.sum() - mean ** 2, 1e-8))
    z = (centre - mean) / scale
    cov, pooled = cov / np.outer(scale, scale), pooled / np.outer(scale, scale)
    factors, dets = [], []
    for c in cov:
        shrunk = (1 - pooled_share) * c + pooled_share * pooled
        shrunk = (1 - diagonal_share) * shrunk + diagonal_share * np.diag(np.diag(shrunk)) + RIDGE * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        dets.append(2 * np.log(np.diag(lower)).sum())
    return Model(mean, scale, z, np.array(factors), np.array(dets), float(np.log(n[1] / n[0])))


def _histogram(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS), np.int64)
        for b in batches:
            x, y = _matrix(b), column(b, "y").to_numpy(zero_copy_only=False)
            at = np.clip((model.difference(x) + BIN_LIMIT) * BINS / (2 * BIN_LIMIT), 0, BINS - 1).astype(np.int64)
            for c in (0, 1):
                total[c] += np.bincount(at[y == c], minlength=BINS)
        yield pa.RecordBatch.from_pydict({"h": [total.ravel().tolist()]})
    return run


def logistic_curve(hist: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits a histogram of differences by class (Newton steps)."""
    at = (np.arange(BINS) + 0.5) * 2 * BIN_LIMIT / BINS - BIN_LIMIT
    design = np.stack([at, np.ones(BINS)])
    n, w = hist.sum(axis=0), np.array([0.1, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        grad = design @ (hist[1] - n * p) - 1e-3 * w
        hess = (design * (n * p * (1 - p))) @ design.T + 1e-3 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hess, grad), -1, 1)
    return float(max(w[0], 1e-3)), float(w[1])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``x``, the transformed statistics of every document, written once."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return materialise(rows.mapInArrow(_statistics, "id bigint, x array<double>"), "doc-stats")


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        pooled_share: float = 0.1, diagonal_share: float = 0.05) -> Model:
    """Fit the model to the statistics of all labelled documents."""
    marks = (labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("bigint").alias("id"))
             .agg(F.min(label_col).cast("int").alias("y")))
    rows = stats.join(marks, "id").select("x", "y")
    n, s, q = np.zeros(2), np.zeros((2, len(FEATURES))), np.zeros((2, len(FEATURES), len(FEATURES)))
    # one row of fixed size for each task and class
    for r in rows.mapInArrow(_moments, "y int, n double, s array<double>, q array<double>").toLocalIterator():
        n[r.y] += r.n
        s[r.y] += np.array(r.s)
        q[r.y] += np.array(r.q).reshape(q[r.y].shape)
    model = densities(n, s, q, pooled_share, diagonal_share)
    if model.constant is not None:
        return model
    hist = np.zeros(2 * BINS, np.int64)
    for r in rows.mapInArrow(_histogram(model), "h array<bigint>").toLocalIterator():
        hist += np.array(r.h)
    slope, shift = logistic_curve(hist.reshape(2, BINS))
    return Model(model.mean, model.scale, model.centres, model.inverse_factors, model.log_dets, model.log_prior, slope, shift)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``id`` and ``score`` (0 to 1, higher: class 1 likelier) of every row of ``stats``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(model.score(_matrix(b)))], names=["id", "score"])
    return stats.mapInArrow(run, "id bigint, score double")


def score_column(model: Model, text: Column) -> Column:
    """The score of a text column, row by row; nothing is shuffled."""
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            x = np.array([statistics(t) for t in as_bytes(part)]).reshape(-1, len(FEATURES))
            yield pa.array(model.score(x))

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(text)
