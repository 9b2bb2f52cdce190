"""Byte-pair merges learned many at a time, exactly as one at a time would.

The table of distinct pre-tokens with their counts (``pieces``) and the table of symbol-pair counts stay in Spark.  A round
proposes up to ``BATCH`` merges, applies them in order to all pieces in one job, and gets back how every pair count changes
with every merge.  From these the driver replays the rule "most frequent pair first, ties to the smaller pair" and accepts
the proposals up to the first one that a merge at a time would not have chosen, so the result does not depend on what was
proposed; only the number of rounds does.

Proposals come from a draft: the same rule run on the driver over the ``DRAFT_PIECES`` most frequent pieces (a bounded
sample), its counts scaled by the exact counts of the best pairs.  What the driver holds is bounded by these parameters; the
pairs it compares are the ``TOP_PAIRS`` that reach most in the round, and a merge counts as right only above all others.

A piece is its symbols in 16 bits each.  The pieces of a batch are laid end to end, so a merge is a few array operations
over the batch and costs the same however many merges are asked.  Accepted merges are applied again by the next rounds'
jobs; the pieces are written anew only when ``REWRITE`` of them have gathered.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenweave.functions.common import TOKEN_ID_LIMIT, bounded_collect, ship_by_value
from tokenweave.operators.bpe import MERGES_SCHEMA, pretoken_counts
from tokenweave.operators.dictionary import frequent_pieces
from tokenweave.sources.shards import passing, written

ship_by_value(__name__)

BATCH = 256
DRAFT_PIECES = 200_000
TOP_PAIRS = 8_000
REWRITE = 128
MOST_ROWS = 1_000_000  # changes that a task gathers before it adds them up
BASE = -1  # in place of a merge's number: the count before the round
CHANGES_SCHEMA = "a int, b int, j int, d bigint"
Pair = tuple[int, int]


class Line:
    """Pieces laid end to end: ``ids`` has -1 before, between and after them, ``at`` the piece of every symbol."""

    def __init__(self, data, lengths):
        at = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        place = np.arange(len(at)) + at + 1
        self.n = len(lengths)
        self.ids = np.full(len(at) + self.n + 1, -1, dtype=np.int32)
        self.at = np.zeros(len(self.ids), dtype=np.int32)
        self.ids[place] = data
        self.at[place] = at

    def copy(self) -> Line:
        out = Line.__new__(Line)
        out.n, out.ids, out.at = self.n, self.ids, self.at  # a merge replaces the arrays
        return out

    def pairs_at(self, i):
        """Pieces and keys of the pairs that begin at ``i``, without those that reach into the next piece."""
        a, b = self.ids[i], self.ids[i + 1]
        whole = (a >= 0) & (b >= 0)
        return self.at[i[whole]], a[whole].astype(np.int64) << 16 | b[whole]

    def find(self, pair: Pair):
        """Where ``pair`` occurs, left to right and not overlapping."""
        p = np.flatnonzero(self.ids == pair[0])
        p = p[self.ids[p + 1] == pair[1]]
        if pair[0] == pair[1] and len(p) > 1:
            k = np.arange(len(p))
            first = np.maximum.accumulate(np.where(np.diff(p, prepend=-2) > 1, k, 0))
            p = p[(k - first) % 2 == 0]
        return p

    def merge(self, pair: Pair, new: int, told: bool = True):
        """Every occurrence of ``pair`` replaced by ``new``; ``(piece, pair, sign)`` of the pairs that go and come."""
        p = self.find(pair)
        if not len(p):
            return None
        if told:
            gone = self.pairs_at(np.unique(np.concatenate([p - 1, p, p + 1])))
        ids = self.ids.copy()
        ids[p] = new
        kept = np.ones(len(ids), dtype=bool)
        kept[p + 1] = False
        self.ids, self.at = ids[kept], self.at[kept]
        if not told:
            return None
        q = p - np.arange(len(p))
        come = self.pairs_at(np.unique(np.concatenate([q - 1, q])))
        sign = np.repeat(np.array([-1, 1], dtype=np.int64), [len(gone[0]), len(come[0])])
        return np.concatenate([gone[0], come[0]]), np.concatenate([gone[1], come[1]]), sign

    def lengths(self):
        return np.bincount(self.at[self.ids >= 0], minlength=self.n)

    def symbols(self):
        return self.ids[self.ids >= 0]


def summed(keys, d):
    """Distinct keys and the sums of their ``d``, without sums of zero."""
    if not len(keys):
        return keys, d
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    sums = np.add.reduceat(d[order], first)
    return keys[first][sums != 0], sums[sums != 0]


def _line(rb) -> tuple[Line, np.ndarray]:
    """The pieces ``(sym, cnt)`` of a batch."""
    import pyarrow.compute as pc

    sym = rb.column(0)
    lengths = pc.binary_length(sym).to_numpy(zero_copy_only=False) // 2
    data = np.frombuffer(b"".join(sym.to_pylist()), dtype="<u2")
    return Line(data, lengths), rb.column(1).to_numpy(zero_copy_only=False).astype(np.int64)


def _changes(keys, j: int, d):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array((keys >> 16 & 0xFFFF).astype(np.int32)), pa.array((keys & 0xFFFF).astype(np.int32)),
                                       pa.array(np.asarray(j, dtype=np.int32)), pa.array(d)], names=["a", "b", "j", "d"])


def _count_kernel(batches):
    for rb in batches:
        line, cnt = _line(rb)
        piece, keys = line.pairs_at(np.arange(len(line.ids) - 1))
        keys, sums = summed(keys, cnt[piece])
        yield _changes(keys, np.full(len(keys), BASE), sums)


def _change_kernel(done: list[tuple[Pair, int]], merges: list[tuple[Pair, int]]):
    """How each of ``merges`` changes the pair counts after the merges ``done``."""
    def run(batches):
        keys, sums, held = [], [], 0
        for rb in batches:
            line, cnt = _line(rb)
            for pair, new in done:
                line.merge(pair, new, told=False)
            for j, (pair, new) in enumerate(merges):
                found = line.merge(pair, new)
                if found is not None:
                    k, d = summed(found[1], found[2] * cnt[found[0]])
                    keys.append(k | j << 32)
                    sums.append(d)
                    held += len(k)
            if held > MOST_ROWS:
                k, d = summed(np.concatenate(keys), np.concatenate(sums))
                keys, sums, held = [k], [d], 0
        if keys:
            k, d = summed(np.concatenate(keys), np.concatenate(sums))
            yield _changes(k, k >> 32, d)
    return run


def _apply_kernel(merges: list[tuple[Pair, int]]):
    """The pieces after the merges; a piece of one symbol has no pair left and is dropped."""
    def run(batches):
        import pyarrow as pa

        for rb in batches:
            line, _ = _line(rb)
            for pair, new in merges:
                line.merge(pair, new, told=False)
            ends = np.concatenate([[0], np.cumsum(line.lengths() * 2)]).astype(np.int32)
            sym = pa.Array.from_buffers(pa.binary(), line.n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(line.symbols().astype("<u2").tobytes())])
            yield pa.RecordBatch.from_arrays([sym, rb.column(1)], names=["sym", "cnt"]).filter(pa.array(np.diff(ends) > 2))
    return run


class Draft:
    """The rule on a bounded sample of pieces; merges can be taken back."""

    def __init__(self, rows: list[tuple[list[int], int]]):
        lengths = np.array([len(w) for w, _ in rows], dtype=np.int64)
        self.line = Line(np.concatenate([np.asarray(w) for w, _ in rows]) if rows else [], lengths)
        self.counts = np.array([c for _, c in rows], dtype=np.int64)
        piece, keys = self.line.pairs_at(np.arange(len(self.line.ids) - 1))
        self.pairs: Counter = Counter(self._told(piece, keys, 1))
        self.settle()

    def _told(self, piece, keys, sign) -> dict[Pair, int]:
        keys, sums = summed(keys, sign * self.counts[piece])
        return dict(zip(zip((keys >> 16).tolist(), (keys & 0xFFFF).tolist()), sums.tolist()))

    @property
    def words(self) -> list[list[int]]:
        return [w.tolist() for w in np.split(self.line.symbols(), np.cumsum(self.line.lengths())[:-1])]

    def settle(self) -> None:
        """The merges so far stay."""
        self.start = self.line.copy()
        self.journal: list[tuple[Pair, int, dict[Pair, int]]] = []

    def merge(self, pair: Pair, new: int) -> dict[Pair, int]:
        """Apply a merge; how the pair counts change."""
        found = self.line.merge(pair, new)
        diff = self._told(*found) if found is not None else {}
        self.pairs.update(diff)
        self.journal.append((pair, new, diff))
        return diff

    def back(self, count: int = 1) -> None:
        """Take the last merges back."""
        for _, _, diff in self.journal[len(self.journal) - count:]:
            self.pairs.subtract(diff)
        del self.journal[len(self.journal) - count:]
        if count:
            self.line = self.start.copy()
            for pair, new, _ in self.journal:
                self.line.merge(pair, new, told=False)

    def propose(self, exact: dict[Pair, int], first: int, count: int) -> tuple[list[Pair], list[float]]:
        """The next merges by the sample's counts, scaled to the ``exact`` counts of the best pairs, and what they should count."""
        scale = {q: c / self.pairs[q] for q, c in exact.items() if self.pairs[q] > 0}
        value = {q: float(c) for q, c in exact.items()}  # pairs that the sample has not stay as they are
        heap = [(-v, q) for q, v in value.items()]
        heapq.heapify(heap)
        made: dict[int, float] = {}
        out, guess = [], []
        while heap and len(out) < count:
            v, pair = heapq.heappop(heap)
            if value.get(pair) != -v:
                continue  # changed meanwhile
            k = len(out)
            out.append(pair)
            guess.append(-v)
            # a pair with a new symbol is scaled like the merge that made the symbol
            made[first + k] = scale.get(pair) or made.get(max(pair), 1.0)
            value.pop(pair)
            for q in self.merge(pair, first + k):
                rate = made.get(max(q)) or scale.get(q)
                if rate and self.pairs[q] > 0 and q != pair:
                    value[q] = round(self.pairs[q] * rate, 3)
                    heapq.heappush(heap, (-value[q], q))
                elif q in scale or max(q) in made:
                    value.pop(q, None)
        return out, guess


def accepted(proposed: list[Pair], series: dict[Pair, tuple[int, dict[int, int]]], least: float, last: Pair | None = None) -> list[int]:
    """Counts of the proposals that a merge at a time would have chosen, up to the first it would not.

    ``series`` has for every pair that ever counts ``least`` or more its count before the round and its change by merge; of
    those that reach just ``least`` only the pairs up to ``last``, if there is one.
    """
    pairs, by_merge = sorted(series), defaultdict(list)
    place = {q: i for i, q in enumerate(pairs)}
    now = np.array([series[q][0] for q in pairs], dtype=np.int64)
    for i, q in enumerate(pairs):
        for j, d in series[q][1].items():
            by_merge[j].append((i, d))
    out = []
    for j, pair in enumerate(proposed):
        have = int(now[place[pair]]) if pair in place else 0
        if have <= 0 or have < least or (have == least and last is not None and pair > last):
            break  # pairs below the bound were not compared
        if int(np.argmax(now)) != place[pair]:  # the first of the highest is the smallest pair
            break
        out.append(have)
        for i, d in by_merge[j]:
            now[i] += d
    return out


def pair_counts(pieces: DataFrame) -> DataFrame:
    """``(a, b, j, d)``: adjacent symbol pairs of the pieces ``(sym, cnt)``, counted; ``j`` is ``BASE``."""
    part = pieces.select("sym", "cnt").mapInArrow(_count_kernel, CHANGES_SCHEMA)
    return part.groupBy("a", "b", "j").agg(F.sum("d").alias("d"))


def _total(chosen) -> Column:
    """Sum of the changes of a pair that ``chosen`` holds for."""
    return F.aggregate(F.filter("diff", chosen), F.lit(0).cast("bigint"), lambda s, x: s + x["d"])


def _best(table: DataFrame) -> tuple[dict[Pair, tuple[int, dict[int, int]]], int, Pair | None]:
    """The ``TOP_PAIRS`` pairs that reach most as ``{pair: (count before, {merge: change})}``, and the last of them if there are more."""
    reach = _total(lambda x: (x["j"] == BASE) | (x["d"] > 0)).alias("reach")
    top = (table.select("a", "b", reach, F.transform("diff", lambda x: x["j"]).alias("j"), F.transform("diff", lambda x: x["d"]).alias("d"))
           .orderBy(F.desc("reach"), "a", "b").limit(TOP_PAIRS).toArrow())
    cols = [top[c].to_pylist() for c in top.column_names]
    series = {}
    for a, b, _, j, d in zip(*cols):
        diff = dict(zip(j, d))
        series[a, b] = diff.pop(BASE, 0), diff
    if len(series) < TOP_PAIRS:
        return series, 1, None
    return series, cols[2][-1], (cols[0][-1], cols[1][-1])


def learn_merges(docs: DataFrame, merges: int, batch: int = BATCH, draft_pieces: int = DRAFT_PIECES) -> DataFrame:
    """``(rank, left, right, token_id, cnt)`` for up to ``merges`` merges, equal pairs to the smaller one first."""
    if 256 + merges > TOKEN_ID_LIMIT:
        raise ValueError(f"at most {TOKEN_ID_LIMIT - 256} merges: a symbol has 16 bits")
    spark = docs.sparkSession
    with passing(spark, "pieces", "pairs"):
        return spark.createDataFrame(_learned(docs, merges, batch, draft_pieces), MERGES_SCHEMA)


def _learned(docs: DataFrame, merges: int, batch: int, draft_pieces: int) -> list[tuple]:
    pieces = written(pretoken_counts(docs), "pieces")
    counts = pair_counts(pieces)
    often = frequent_pieces(pieces, draft_pieces)
    draft = Draft([(np.frombuffer(r["sym"], "<u2"), r["cnt"]) for r in
                   bounded_collect(pieces.where(F.col("cnt") >= often).select("sym", "cnt"), draft_pieces, "draft")])
    learned: list[tuple] = []
    plan: list[tuple[Pair, int]] = []
    pending: list[tuple[Pair, int]] = []  # accepted, but not in the written pieces
    while True:  # the first round only counts
        changes = counts
        if plan:
            changes = counts.unionByName(pieces.select("sym", "cnt").mapInArrow(_change_kernel(pending, plan), CHANGES_SCHEMA))
        table = written(changes.groupBy("a", "b", "j").agg(F.sum("d").alias("d"))
                        .groupBy("a", "b").agg(F.collect_list(F.struct("j", "d")).alias("diff")), "pairs")
        series, least, last = _best(table)
        proposed = [q for q, _ in plan]
        got = accepted(proposed, series, least, last)
        if plan and not got:
            if last is None or exact[proposed[0]] > least:
                raise RuntimeError("the most frequent pair was not proposed first")
            got = [exact[proposed[0]]]  # not above all that was left out, but the most frequent when the round began
        done = len(got)
        learned += [(new - 256, *q, new, c) for (q, new), c in zip(plan, got)]
        draft.back(len(plan) - done)
        draft.settle()
        pending += plan[:done]
        if len(learned) >= merges:
            break
        counts = table.select("a", "b", F.lit(BASE).alias("j"), _total(lambda x: x["j"] < done).alias("d")).where("d > 0")
        exact = {q: c + sum(d for j, d in diff.items() if j < done) for q, (c, diff) in series.items()}
        exact = {q: c for q, c in exact.items() if c > 0}
        if last is not None and (not exact or max(exact.values()) <= least):  # a pair left out may count as much
            top = counts.orderBy(F.desc("d"), "a", "b").limit(TOP_PAIRS).collect()
            exact = {(r["a"], r["b"]): r["d"] for r in top}
        if not exact:
            break
        if len(pending) >= REWRITE:
            pieces, pending = written(pieces.select("sym", "cnt").mapInArrow(_apply_kernel(pending), "sym binary, cnt bigint"), "pieces"), []
        ask, first = 2 * done + 8, 256 + len(learned)  # about as many more as were right
        proposed, _ = draft.propose(exact, first, min(ask, batch, merges - len(learned)))
        plan = [(q, first + k) for k, q in enumerate(proposed)]
    return learned
