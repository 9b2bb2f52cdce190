"""DuckDB oracle SQL for every registered query.

Plain SQL over the raw parquet views, written row-at-a-time where that is
possible (one row per token, a global running sum, a self-join for
next-token pairs; segments are token rows grouped by document and shard).
The batch schedule uses the same closed form as the Spark side; the tests
check that form against a sequential loader.  Parameters come from the same
``PackParams`` defaults.
"""

from __future__ import annotations

from tokenweave.operators.evaluate import MAX_LR, MIN_LR
from tokenweave.operators.tokens import BYTE_EOT
from tokenweave.params import RANKED, PackParams, rank_path
from tokenweave.sources.metrics import STEP_LINE

P_ = PackParams()
B, T, BT, R = P_.B, P_.T, P_.BT, P_.ranks
EOT = BYTE_EOT
WV, UNK, WORD_EOT = P_.word_vocab_size, P_.unk_id, P_.eot_id
EVERY, CKPT = P_.eval_every, P_.checkpoint_every
K, NSEQ, NEW, SEED = P_.top_k, P_.num_sequences, P_.new_tokens, P_.seed
PREFIX = P_.shard_prefix

def with_(*names: str) -> str:
    return _with(names, {})


def _with(names: tuple[str, ...], own: dict) -> str:
    """``WITH`` and what the named tables need; ``own`` tables take the place of the common ones and all are materialised."""
    order: list[str] = []
    tables = _CTE | own

    def visit(n: str) -> None:
        if n in order:
            return
        for d in tables[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    kind = lambda n: "(k, cnt, sym) USING KEY (k) AS" if n == "learned" else "AS MATERIALIZED" if n == "m0" or own and n != "merged" else "AS"
    return "WITH RECURSIVE " + ",\n".join(f"{n} {kind(n)} ({tables[n][0]})" for n in order) + "\n"


def _p(cxy: str, cx: str, cy: str, n: str) -> str:
    return (f"(0.5 * CASE WHEN {cx} > 0 THEN CAST({cxy} AS DOUBLE) / {cx} ELSE 0.0 END"
            f" + 0.5 * CAST({cy} + 1 AS DOUBLE) / CAST({n} + (SELECT v FROM vsize) AS DOUBLE))")


def _scored(src: str, keys: str) -> str:
    p = _p("coalesce(b.cxy, 0)", "coalesce(c.cx, 0)", "coalesce(u.cy, 0)", "(SELECT N FROM ntot)")
    return f"""SELECT {keys}, s.cnt, -ln({p}) AS nll FROM {src} s
        LEFT JOIN big b ON b.x = s.x AND b.y = s.y LEFT JOIN ctx c ON c.x = s.x
        LEFT JOIN uni u ON u.y = s.y"""


def _u(*parts: str) -> str:
    s = f"concat_ws('|', {', '.join(parts)})"
    return f"((('0x' || substr(md5({s}), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE)"


def _tables(p: PackParams) -> dict[str, tuple[str, tuple[str, ...]]]:
    """The tables behind the queries, by name, with what each needs, for one set of parameters."""
    S, B, T, BT, R = p.shard_size, p.B, p.T, p.BT, p.ranks
    TOTAL, ACC, NVAL, EVERY, K = p.total_batch, p.accum_steps, p.val_batches, p.eval_every, p.top_k
    out: dict[str, tuple[str, tuple[str, ...]]] = {}

    def cte(name: str, sql: str, *deps: str) -> None:
        out[name] = (sql, deps)

    # ---------------------------------------------------------------- tokens, offsets, segments
    cte("docs", "SELECT doc_id, coalesce(text, '') AS text FROM documents")
    cte("wl", r"SELECT doc_id, regexp_extract_all(text, '[^ \t\r\n]+') AS w FROM docs", "docs")
    cte("wlens", "SELECT doc_id, CAST(len(w) + 1 AS BIGINT) AS n FROM wl", "wl")
    cte("lens", "SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS n FROM docs", "docs")
    cte("offs", """SELECT doc_id, n, CAST(coalesce(sum(n) OVER (ORDER BY doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM lens""", "lens")
    cte("wc", "SELECT word, count(*) AS cnt FROM (SELECT unnest(w) AS word FROM wl) GROUP BY word", "wl")
    cte("vocab", f"""SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS INTEGER)
            AS token_id, word, CAST(cnt AS BIGINT) AS cnt FROM wc) WHERE token_id < {WV - 2}""", "wc")
    cte("tw", "SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM wl", "wl")
    cte("toks", f"""SELECT doc_id, CAST(0 AS BIGINT) AS i, CAST({EOT} AS BIGINT) AS id FROM docs
            UNION ALL
            SELECT doc_id, CAST(unnest(generate_series(1, len(h))) AS BIGINT), CAST('0x' || unnest(h) AS BIGINT)
            FROM (SELECT doc_id, regexp_extract_all(hex(text), '..') AS h FROM docs)""", "docs")
    cte("tp", f"""SELECT t.doc_id, t.i, t.id, (o.off + t.i) // {S} AS shard_index,
            (o.off + t.i) % {S} AS pos FROM toks t JOIN offs o USING (doc_id)""", "toks", "offs")
    cte("segs", """SELECT CASE WHEN shard_index = 0 THEN 'val' ELSE 'train' END AS split,
            CAST(shard_index AS BIGINT) AS shard_index, CAST(min(pos) AS BIGINT) AS pos, doc_id,
            CAST(min(i) AS BIGINT) AS src, CAST(count(*) AS BIGINT) AS n,
            CAST(any_value(dn) AS BIGINT) AS doc_n
            FROM (SELECT tp.*, l.n AS dn FROM tp JOIN lens l USING (doc_id))
            GROUP BY doc_id, shard_index""", "tp", "lens")

    # ---------------------------------------------------------------- batching
    cte("sl", """SELECT CASE WHEN shard_index = 0 THEN 'val' ELSE 'train' END AS split,
            CAST(shard_index AS BIGINT) AS shard_index, CAST(count(*) AS BIGINT) AS L
            FROM tp GROUP BY ALL""", "tp")
    cte("rs", f"""SELECT split, shard_index, CAST(r AS BIGINT) AS rank, L,
            CAST(CASE WHEN r * {BT} + {BT} + 1 > L THEN 0
                 ELSE greatest(1, (L - 1 - r * {BT}) // {BT * R}) END AS BIGINT) AS nb,
            r * {BT} + {BT} + 1 > L AS too_short
            FROM sl, range({R}) t(r)""", "sl")
    cte("sched", f"""SELECT split, rank, CAST(first_batch + j AS BIGINT) AS batch_no, shard_index,
            CAST(j AS BIGINT) AS j, CAST(rank + j * {R} AS BIGINT) AS slot,
            CAST((rank + j * {R}) * {BT} AS BIGINT) AS start
            FROM (SELECT *, unnest(range(nb)) AS j FROM (
                  SELECT *, CAST(coalesce(sum(nb) OVER (PARTITION BY split, rank ORDER BY shard_index
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_batch
                  FROM rs) WHERE nb > 0)""", "rs")
    cte("xs", f"""SELECT shard_index, pos // {BT} AS slot, CAST(sum(id) AS BIGINT) AS x_sum,
            CAST(sum(id * ((pos % {BT}) % 1009 + 1)) AS BIGINT) AS x_wsum FROM tp GROUP BY ALL""", "tp")
    cte("ys", f"""SELECT shard_index, (pos - 1) // {BT} AS slot, CAST(sum(id) AS BIGINT) AS y_sum,
            CAST(sum(id * (((pos - 1) % {BT}) % 1009 + 1)) AS BIGINT) AS y_wsum
            FROM tp WHERE pos >= 1 GROUP BY ALL""", "tp")
    cte("slot_pairs", f"""SELECT a.shard_index, a.pos // {BT} AS slot, a.id AS x, b.id AS y,
            count(*) AS cnt FROM tp a JOIN tp b ON a.shard_index = b.shard_index AND b.pos = a.pos + 1
            GROUP BY ALL""", "tp")
    cte("per_epoch", "SELECT split, rank, CAST(count(*) AS BIGINT) AS per_epoch FROM sched GROUP BY ALL",
        "sched")
    cte("max_steps", f"""SELECT CAST(coalesce(sum(L), 0) // {TOTAL} AS BIGINT) AS m
            FROM sl WHERE split = 'train'""", "sl")
    cte("tplan", f"""SELECT w.split, w.rank, w.batch_no, CAST(w.batch_no // {ACC} AS BIGINT) AS step,
            CAST(w.batch_no % {ACC} AS BIGINT) AS micro_step,
            CAST(w.batch_no // e.per_epoch AS BIGINT) AS epoch, s.shard_index, s.slot
            FROM (SELECT DISTINCT split, rank FROM sched WHERE split = 'train') r0
            JOIN LATERAL (SELECT r0.split, r0.rank, unnest(range((SELECT m FROM max_steps) * {ACC})) AS batch_no) w
              ON TRUE
            JOIN per_epoch e ON e.split = w.split AND e.rank = w.rank
            JOIN sched s ON s.split = w.split AND s.rank = w.rank AND s.batch_no = w.batch_no % e.per_epoch""",
        "sched", "per_epoch", "max_steps")
    cte("vplan", f"""SELECT w.split, w.rank, w.batch_no, CAST(w.batch_no // e.per_epoch AS BIGINT) AS epoch,
            s.shard_index, s.slot
            FROM (SELECT split, rank, unnest(range({NVAL})) AS batch_no
                  FROM (SELECT DISTINCT split, rank FROM sched WHERE split = 'val')) w
            JOIN per_epoch e ON e.split = w.split AND e.rank = w.rank
            JOIN sched s ON s.split = w.split AND s.rank = w.rank AND s.batch_no = w.batch_no % e.per_epoch""",
        "sched", "per_epoch")

    # ---------------------------------------------------------------- evaluation
    cte("tps", """SELECT p.step, sp.x, sp.y, CAST(sum(sp.cnt) AS BIGINT) AS cnt
            FROM tplan p JOIN slot_pairs sp ON sp.shard_index = p.shard_index AND sp.slot = p.slot
            GROUP BY ALL""", "tplan", "slot_pairs")
    cte("vps", """SELECT p.rank, p.batch_no, sp.x, sp.y, CAST(sum(sp.cnt) AS BIGINT) AS cnt
            FROM vplan p JOIN slot_pairs sp ON sp.shard_index = p.shard_index AND sp.slot = p.slot
            GROUP BY ALL""", "vplan", "slot_pairs")
    cte("big", "SELECT x, y, CAST(sum(cnt) AS BIGINT) AS cxy FROM tps GROUP BY ALL", "tps")
    cte("ctx", "SELECT x, CAST(sum(cxy) AS BIGINT) AS cx FROM big GROUP BY ALL", "big")
    cte("uni", "SELECT y, CAST(sum(cxy) AS BIGINT) AS cy FROM big GROUP BY ALL", "big")
    cte("vsize", f"SELECT {p.vocab_size} AS v")
    cte("ntot", "SELECT CAST(coalesce(sum(cy), 0) AS BIGINT) AS N FROM uni", "uni", "vsize")

    cte("vscored", _scored("vps", "s.rank, s.batch_no"), "vps", "big", "ctx", "uni", "ntot")
    cte("tscored", _scored("tps", "s.step"), "tps", "big", "ctx", "uni", "ntot")
    cte("vbatch", """SELECT rank, batch_no, sum(nll * cnt) / sum(cnt) AS loss FROM vscored GROUP BY ALL""",
        "vscored")
    cte("vrank", "SELECT rank, avg(loss) AS loss FROM vbatch GROUP BY ALL", "vbatch")
    cte("tstep", "SELECT step, sum(nll * cnt) / sum(cnt) AS loss FROM tscored GROUP BY ALL", "tscored")
    cte("evals", f"""SELECT CAST(i AS BIGINT) AS ei, CAST(i * {EVERY} AS BIGINT) AS m
            FROM range(((SELECT m FROM max_steps) - 1) // {EVERY} + 1) t(i)""", "max_steps")
    cte("big_m", """SELECT e.ei, t.x, t.y, CAST(sum(t.cnt) AS BIGINT) AS cxy FROM evals e
            JOIN tps t ON t.step < e.m GROUP BY ALL""", "evals", "tps")
    cte("ctx_m", "SELECT ei, x, CAST(sum(cxy) AS BIGINT) AS cx FROM big_m GROUP BY ALL", "big_m")
    cte("uni_m", "SELECT ei, y, CAST(sum(cxy) AS BIGINT) AS cy FROM big_m GROUP BY ALL", "big_m")
    cte("n_m", """SELECT e.ei, CAST(coalesce(sum(u.cy), 0) AS BIGINT) AS N FROM evals e
            LEFT JOIN uni_m u ON u.ei = e.ei GROUP BY ALL""", "evals", "uni_m", "vsize")
    cte("curve", f"""SELECT ei * {EVERY} AS step, 'val' AS split, avg(loss) AS loss FROM (
              SELECT ei, rank, avg(loss) AS loss FROM (
                SELECT e.ei, s.rank, s.batch_no,
                       sum(s.cnt * -ln({_p('coalesce(b.cxy, 0)', 'coalesce(c.cx, 0)', 'coalesce(u.cy, 0)', 'nm.N')}))
                       / sum(s.cnt) AS loss
                FROM evals e JOIN vps s ON TRUE
                JOIN n_m nm ON nm.ei = e.ei
                LEFT JOIN big_m b ON b.ei = e.ei AND b.x = s.x AND b.y = s.y
                LEFT JOIN ctx_m c ON c.ei = e.ei AND c.x = s.x
                LEFT JOIN uni_m u ON u.ei = e.ei AND u.y = s.y
                GROUP BY ALL) GROUP BY ALL) GROUP BY ALL""", "evals", "vps", "n_m", "big_m", "ctx_m", "uni_m")
    cte("steps", "SELECT DISTINCT step FROM tplan", "tplan")

    # ---------------------------------------------------------------- prompts and sampling
    cte("bench", "SELECT item_id, coalesce(text, '') AS text FROM benchmark")
    cte("ptoks", """SELECT item_id, CAST(unnest(generate_series(1, len(h))) - 1 AS BIGINT) AS i,
            CAST('0x' || unnest(h) AS BIGINT) AS id
            FROM (SELECT item_id, regexp_extract_all(hex(text), '..') AS h FROM bench)""", "bench")
    cte("starts", """SELECT b.item_id, coalesce(t.ids, []) AS ids FROM bench b LEFT JOIN (
            SELECT item_id, list(id ORDER BY i) AS ids FROM ptoks GROUP BY item_id) t ON t.item_id = b.item_id""", "bench", "ptoks")
    cte("emb_p", """SELECT vec_id, idx, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM (
            SELECT vec_id, idx, exp(v - max(v) OVER (PARTITION BY vec_id)) AS e FROM (
              SELECT vec_id, CAST(unnest(generate_series(1, len(embedding))) - 1 AS BIGINT) AS idx,
                     CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings))""")
    cte("emb_top", f"""SELECT * FROM (SELECT vec_id, idx, p, CAST(row_number() OVER (PARTITION BY vec_id
            ORDER BY p DESC, idx) AS BIGINT) AS rank_in_group FROM emb_p) WHERE rank_in_group <= {K}""",
        "emb_p")

    cte("top_uni", f"SELECT y, cy FROM uni ORDER BY cy DESC, y LIMIT {K}", "uni")
    # the candidates of every context, and those of one never seen (x = -1)
    cte("cands", f"""SELECT x, y, p FROM (
            SELECT x, y, p, row_number() OVER (PARTITION BY x ORDER BY p DESC, y) AS rk FROM (
              SELECT k.x, k.y, {_p('k.cxy', 'coalesce(c.cx, 0)', 'k.cy', '(SELECT N FROM ntot)')} AS p
              FROM (SELECT x, y, max(cxy) AS cxy, max(cy) AS cy FROM (
                      SELECT b.x, b.y, b.cxy, u.cy FROM big b JOIN uni u ON u.y = b.y
                      UNION ALL SELECT ctx.x, tu.y, 0, tu.cy FROM ctx, top_uni tu
                      UNION ALL SELECT -1, tu.y, 0, tu.cy FROM top_uni tu) GROUP BY x, y) k
              LEFT JOIN ctx c ON c.x = k.x)) WHERE rk <= {K}""", "big", "uni", "ctx", "ntot", "top_uni")
    return out


_CTE = _tables(P_)
_STEP_KEY = f"ln(c.p) - ln(-ln({_u(f"'{SEED}'", 'g.item_id', 'g.seq', 'g.t', 'c.y')}))"


def _generation(select: str, own: dict) -> str:
    """Sequences grown one token at a time by a recursive query, until each has its new tokens."""
    return f"""{_with(("starts", "cands"), own)}, known AS (SELECT DISTINCT x FROM cands),
        g AS (SELECT item_id, CAST(s AS BIGINT) AS seq, CAST(0 AS BIGINT) AS t, ids FROM starts, range({NSEQ}) r(s)
          UNION ALL
          SELECT g.item_id, g.seq, any_value(g.t) + 1, list_append(any_value(g.ids), arg_max(c.y, {_STEP_KEY}))
          FROM g LEFT JOIN known k ON k.x = g.ids[-1] JOIN cands c ON c.x = coalesce(k.x, -1)
          WHERE g.t < {NEW} GROUP BY g.item_id, g.seq)
        {select} FROM (SELECT item_id, seq, arg_max(ids, t) AS ids FROM g GROUP BY item_id, seq)"""


# ---------------------------------------------------------------- byte-pair merges, one after the other
# RE2 has no look-ahead: a marker before the last blank of a run that a word follows splits the run there.
_PIECES = r"""regexp_extract_all(regexp_replace(text, '(\s)(\S)', chr(1) || '\1\2', 'g'),
        '''(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x01]+|\s+')"""
_CTE["pre"] = (f"SELECT doc_id, unnest({_PIECES}) AS piece FROM docs", ("docs",))
_CTE["m0"] = ("""SELECT piece, cnt, CAST(row_number() OVER () AS BIGINT) AS k, '<' || array_to_string(list_transform(regexp_extract_all(hex(piece), '..'),
        lambda b: CAST('0x' || b AS INTEGER)), '><') || '>' AS sym FROM (SELECT piece, count(*) AS cnt FROM pre GROUP BY piece)""", ("pre",))
# One merge a step.  Keys above 0 are pieces, as strings of symbols (<116><104> for "th", so a merge is a replacement);
# a merge of rank r is kept under the key -r with its pair and its count.
_CTE["learned"] = (f"""SELECT k, cnt, sym FROM m0
          UNION ALL
          (WITH best AS MATERIALIZED (
              SELECT a, b, sum(cnt) AS c FROM (SELECT cnt, unnest(ids[:-2]) AS a, unnest(ids[2:]) AS b FROM (
                SELECT cnt, list_transform(string_split(sym[2:-2], '><'), lambda s: CAST(s AS INTEGER)) AS ids
                FROM recurring.learned WHERE k > 0 AND contains(sym, '><'))) GROUP BY a, b ORDER BY c DESC, a, b LIMIT 1),
            so_far AS (SELECT count(*) AS n FROM recurring.learned WHERE k <= 0)
          SELECT m.k, m.cnt, replace(m.sym, '<' || a || '><' || b || '>', '<' || (256 + n) || '>') FROM recurring.learned m, best, so_far
          WHERE n < {P_.bpe_merges} AND m.k > 0 AND contains(m.sym, '<' || a || '><' || b || '>')
          UNION ALL SELECT -n, c, a || ' ' || b FROM best, so_far WHERE n < {P_.bpe_merges})""", ("m0",))


# ---------------------------------------------------------------- byte pairs of the given rank table
def _rank_tables(path: str) -> dict[str, tuple[str, tuple[str, ...]]]:
    """Tables that take the place of the byte tokens': every distinct piece is merged pair by pair, lowest rank first."""
    pieces = lambda src, key: f"""SELECT {key}, unnest(l) AS piece, unnest(range(len(l))) AS k FROM (
        SELECT {key}, {_PIECES} AS l FROM {src})"""  # noqa: E731
    ids = lambda src, key, first: f"""SELECT {key}, CAST({first} + row_number() OVER (PARTITION BY {key} ORDER BY k, j) AS BIGINT) AS i, id
        FROM {src} JOIN piece_ids USING (piece)"""  # noqa: E731
    return {
        "ranks": (f"""SELECT hex(from_base64(token)) AS h, id FROM read_csv('{path}', delim=' ', header=false, quote='', escape='',
            columns={{'token': 'VARCHAR', 'id': 'BIGINT'}})""", ()),
        "doc_pieces": (pieces("docs", "doc_id"), ("docs",)),
        "item_pieces": (pieces("bench", "item_id"), ("bench",)),
        "merged": ("""SELECT piece, regexp_extract_all(hex(piece), '..') AS parts FROM (
              SELECT piece FROM doc_pieces UNION SELECT piece FROM item_pieces)
            UNION ALL
            SELECT b.piece, b.parts[:m.i - 1] || [b.parts[m.i] || b.parts[m.i + 1]] || b.parts[m.i + 2:]
            FROM merged b JOIN (
              SELECT p.piece, arg_min(p.i, r.id * 1000000 + p.i) AS i FROM (
                SELECT piece, unnest(range(1, len(parts))) AS i,
                       unnest(list_transform(range(1, len(parts)), lambda i: parts[i] || parts[i + 1])) AS h FROM merged) p
              JOIN ranks r ON r.h = p.h GROUP BY p.piece) m ON m.piece = b.piece""", ("doc_pieces", "item_pieces", "ranks")),
        "piece_ids": ("""SELECT e.piece, e.j, r.id FROM (
              SELECT piece, unnest(parts) AS h, unnest(range(len(parts))) AS j FROM (
                SELECT piece, arg_min(parts, len(parts)) AS parts FROM merged GROUP BY piece)) e JOIN ranks r ON r.h = e.h""", ("merged", "ranks")),
        "toks": (f"SELECT doc_id, CAST(0 AS BIGINT) AS i, CAST({RANKED.vocab_size - 1} AS BIGINT) AS id FROM docs UNION ALL "
                 + ids("doc_pieces", "doc_id", 0), ("docs", "doc_pieces", "piece_ids")),
        "lens": ("SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM toks GROUP BY doc_id", ("toks",)),
        "ptoks": (ids("item_pieces", "item_id", -1), ("item_pieces", "piece_ids")),
    }


# ---------------------------------------------------------------- the oracle per key
_SEGMENT_SUMMARY = with_("segs", "tp") + """
        SELECT s.split, s.shard_index, s.pos, s.doc_id, s.src, s.n, s.doc_n,
               CAST(sum(t.id) AS BIGINT) AS id_sum, arg_min(t.id, t.pos) AS first_id,
               arg_max(t.id, t.pos) AS last_id
        FROM segs s JOIN tp t ON t.doc_id = s.doc_id AND t.shard_index = s.shard_index
        GROUP BY ALL"""

def _chain_sql(own: dict, hexed: str) -> dict[str, str]:
    """Queries of the chain over the common tables, or over ``own`` tokens; ``hexed`` is the bytes of list ``ids`` in hex."""
    w = lambda *names: _with(names, own)
    return {
        "shard_manifest": w("segs") + f"""
            SELECT split, shard_index, CAST(sum(n) AS BIGINT) AS n_tokens,
                   CAST(count(*) AS BIGINT) AS n_segments, min(doc_id) AS first_doc,
                   max(doc_id) AS last_doc, printf('{PREFIX}_%s_%06d', split, shard_index) AS label
            FROM segs GROUP BY split, shard_index""",
        "batches": w("sched", "xs", "ys") + """
            SELECT s.split, s.rank, s.batch_no, s.shard_index, s.slot, x.x_sum, y.y_sum, x.x_wsum, y.y_wsum
            FROM sched s JOIN xs x ON x.shard_index = s.shard_index AND x.slot = s.slot
            JOIN ys y ON y.shard_index = s.shard_index AND y.slot = s.slot""",
        "next_token_pairs": w("sched", "slot_pairs") + """
            SELECT s.split, p.x, p.y, CAST(sum(p.cnt) AS BIGINT) AS cnt FROM sched s
            JOIN slot_pairs p ON p.shard_index = s.shard_index AND p.slot = s.slot GROUP BY ALL""",
        "ngram_model": w("big", "ctx", "uni", "ntot") + f"""
            SELECT b.x, b.y, b.cxy AS cnt, round({_p('b.cxy', 'c.cx', 'u.cy', '(SELECT N FROM ntot)')}, 9) AS p
            FROM big b JOIN ctx c ON c.x = b.x JOIN uni u ON u.y = b.y""",
        "cross_entropy": w("vscored") + """
            SELECT round(sum(nll * cnt) / sum(cnt), 4) AS loss, CAST(sum(cnt) AS BIGINT) AS n_tokens
            FROM vscored""",
        "val_loss_by_rank": w("vrank") + "SELECT rank, round(loss, 4) AS loss FROM vrank",
        "val_loss": w("vrank") + "SELECT round(avg(loss), 4) AS loss FROM vrank",
        "train_loss_by_step": w("tstep") + "SELECT step, round(loss, 4) AS loss FROM tstep",
        "train_loss_online": w("tps", "ntot") + f"""
            SELECT step, round(sum(cnt * -ln({_p('cxy', 'cx', 'cy', 'nb')})) / sum(cnt), 4) AS loss FROM (
              SELECT t.step, t.cnt,
                     coalesce((SELECT sum(a.cnt) FROM tps a WHERE a.x = t.x AND a.y = t.y AND a.step < t.step), 0) AS cxy,
                     coalesce((SELECT sum(a.cnt) FROM tps a WHERE a.x = t.x AND a.step < t.step), 0) AS cx,
                     coalesce((SELECT sum(a.cnt) FROM tps a WHERE a.y = t.y AND a.step < t.step), 0) AS cy,
                     coalesce((SELECT sum(a.cnt) FROM tps a WHERE a.step < t.step), 0) AS nb
              FROM tps t) GROUP BY step""",
        "val_curve": w("curve") + "SELECT step, split, round(loss, 4) AS loss FROM curve",
        "encode_prompts": w("ptoks") + """
            SELECT item_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(id) AS BIGINT) AS id_sum,
                   CAST(sum(id * (i % 1009 + 1)) AS BIGINT) AS id_wsum FROM ptoks GROUP BY item_id""",
        "doc_tokens": w("toks") + """
        SELECT doc_id, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum, CAST(sum(id * (i % 1009 + 1)) AS BIGINT) AS id_wsum
        FROM toks GROUP BY doc_id""",
        "shards_roundtrip": "SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, md5(coalesce(text, '')) AS md5 "
                            "FROM documents",
        "generate": _generation(f"""SELECT item_id, seq, CAST(len(ids) AS BIGINT) AS n, array_to_string(ids, ' ') AS tokens,
        {hexed} AS bytes_hex""", own),
    }


ORACLE_SQL: dict[str, str] = {
    "corpus_scan": "SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars, "
                   "CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes FROM documents",
    "corpus_split_scan": "SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars, "
                         "CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes FROM documents "
                         "WHERE lang = 'en'",
    "doc_token_lengths": with_("wlens") + "SELECT doc_id, n FROM wlens",
    "doc_offsets": with_("offs") + "SELECT doc_id, n, off FROM offs",
    "unkeyed_offsets": """SELECT doc_id, n, CAST(coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
        AS off FROM (SELECT row_number() OVER () - 1 AS doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS n FROM documents)""",
    "shard_segments": _SEGMENT_SUMMARY,
    "stream_pack": _SEGMENT_SUMMARY,
    "word_vocab": with_("vocab") + "SELECT token_id, word, cnt FROM vocab",
    "byte_token_lengths": "SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS n "
                          "FROM documents",
    "token_range_check": with_("toks") + """
        SELECT CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs, CAST(count(*) AS BIGINT) AS n_tokens,
               CAST(count(*) FILTER (WHERE id < 0 OR id >= 65536) AS BIGINT) AS n_out_of_range,
               min(id) AS min_id, max(id) AS max_id FROM toks""",
    "shard_token_checksum": with_("tp") + """
        SELECT CASE WHEN shard_index = 0 THEN 'val' ELSE 'train' END AS split,
               CAST(shard_index AS BIGINT) AS shard_index,
               CAST(sum(id * (pos % 1009)) AS BIGINT) AS checksum, CAST(sum(id) AS BIGINT) AS id_sum,
               CAST(count(*) AS BIGINT) AS n_tokens FROM tp GROUP BY ALL""",
    "list_shards": with_("segs") + f"""
        SELECT split, shard_index, CAST(sum(n) AS BIGINT) AS n_tokens,
               printf('{PREFIX}_%s_%06d', split, shard_index) AS label
        FROM segs GROUP BY split, shard_index""",
    "load_shard_tokens": with_("segs", "tp") + """
        SELECT s.split, s.shard_index, s.pos, s.doc_id, s.n, CAST(sum(t.id) AS BIGINT) AS id_sum,
               arg_max(t.id, t.pos) AS last_id
        FROM segs s JOIN tp t ON t.doc_id = s.doc_id AND t.shard_index = s.shard_index
        GROUP BY ALL""",
    "batch_schedule": with_("sched") + "SELECT * FROM sched",
    "locate_batches": with_("sched", "per_epoch") + """
        SELECT s.split, s.rank, CAST(e * p.per_epoch + s.batch_no AS BIGINT) AS batch_no, CAST(e AS BIGINT) AS epoch, s.shard_index, s.slot
        FROM sched s JOIN per_epoch p ON p.split = s.split AND p.rank = s.rank, range(3) t(e)""",
    "batch_rows": with_("sched", "tp") + f"""
        SELECT s.split, s.rank, s.batch_no, xr.row, xr.x_sum, yr.y_wsum FROM sched s
        JOIN (SELECT shard_index, pos // {BT} AS slot, CAST((pos % {BT}) // {T} AS BIGINT) AS row,
                     CAST(sum(id) AS BIGINT) AS x_sum FROM tp GROUP BY ALL) xr
          ON xr.shard_index = s.shard_index AND xr.slot = s.slot
        JOIN (SELECT shard_index, (pos - 1) // {BT} AS slot, CAST(((pos - 1) % {BT}) // {T} AS BIGINT) AS row,
                     CAST(sum(id * (((pos - 1) % {T}) % 1009 + 1)) AS BIGINT) AS y_wsum
              FROM tp WHERE pos >= 1 GROUP BY ALL) yr
          ON yr.shard_index = s.shard_index AND yr.slot = s.slot AND yr.row = xr.row""",
    "val_batches": with_("vplan", "xs", "ys") + """
        SELECT v.rank, v.batch_no, v.epoch, v.shard_index, v.slot, x.x_sum, y.y_wsum
        FROM vplan v JOIN xs x ON x.shard_index = v.shard_index AND x.slot = v.slot
        JOIN ys y ON y.shard_index = v.shard_index AND y.slot = v.slot""",
    "accumulation_plan": with_("tplan") + "SELECT * FROM tplan",
    "epoch_wrap": with_("tplan", "per_epoch") + """
        SELECT t.split, t.rank, CAST(count(*) AS BIGINT) AS n_planned,
               CAST(max(t.epoch) + 1 AS BIGINT) AS n_epochs, any_value(e.per_epoch) AS per_epoch
        FROM tplan t JOIN per_epoch e ON e.split = t.split AND e.rank = t.rank GROUP BY t.split, t.rank""",
    "dropped_tail": with_("rs") + f"""
        SELECT split, shard_index, rank, L, nb, too_short,
               CASE WHEN too_short THEN NULL ELSE CAST((rank + nb * {R}) * {BT} AS BIGINT) END AS stop_at
        FROM rs""",
    "tokens_per_step": with_("tplan") + f"""
        SELECT step, CAST(count(*) * {BT} AS BIGINT) AS tokens FROM tplan GROUP BY step""",
    "eval_schedule": with_("steps", "max_steps") + f"""
        SELECT step, (step > 0 AND (step % {CKPT} = 0 OR step = (SELECT m FROM max_steps) - 1))
               AS is_checkpoint FROM steps WHERE step % {EVERY} = 0""",
    "lr_schedule": with_("steps", "max_steps") + f"""
        SELECT step, round(CASE WHEN step < w THEN {MAX_LR} * (step + 1) / w
                                WHEN step > m THEN {MIN_LR}
                                ELSE {MIN_LR} + 0.5 * (1.0 + cos(pi() * ((step - w) / greatest(1, m - w))))
                                     * ({MAX_LR} - {MIN_LR}) END, 9) AS lr
        FROM steps, (SELECT m, CAST(greatest(1, m // 10) AS DOUBLE) AS w FROM max_steps) p""",
    "metrics_log_lines": with_("curve") + """
        SELECT CAST(step AS BIGINT) AS step, printf('%d %s %.4f', step, split, loss) AS value FROM curve""",
    "parse_metrics_log": with_("curve") + """
        SELECT CAST(step AS BIGINT) AS step, split, CAST(printf('%.4f', loss) AS DOUBLE) AS loss FROM curve""",
    "step_report": with_("tstep", "tplan") + f"""
        SELECT s.step, printf('{STEP_LINE}', s.step, s.loss, t.tokens) AS line
        FROM tstep s JOIN (SELECT step, count(*) * {BT} AS tokens FROM tplan GROUP BY step) t
          ON t.step = s.step""",
    "segment_group_totals": with_("segs") + """
        SELECT split, CAST(count(*) AS BIGINT) AS n_pieces,
               CAST(count(*) FILTER (WHERE src = 0 AND n = doc_n) AS BIGINT) AS n_whole,
               CAST(count(*) FILTER (WHERE NOT (src = 0 AND n = doc_n)) AS BIGINT) AS n_cut,
               CAST(coalesce(sum(n) FILTER (WHERE src = 0 AND n = doc_n), 0) AS BIGINT) AS tokens_whole,
               CAST(coalesce(sum(n) FILTER (WHERE NOT (src = 0 AND n = doc_n)), 0) AS BIGINT) AS tokens_cut
        FROM segs GROUP BY split""",
    "global_norm_clip": """
        WITH sq AS (SELECT vec_id, embedding,
                    list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))) AS s
                    FROM embeddings),
             g AS (SELECT sqrt(sum(s)) AS norm FROM sq)
        SELECT vec_id, round(g.norm, 6) AS global_norm,
               round(sqrt(list_sum(list_transform(embedding,
                     lambda v: (CAST(v AS DOUBLE) * least(1.0, 1.0 / g.norm))
                          * (CAST(v AS DOUBLE) * least(1.0, 1.0 / g.norm))))), 6) AS clipped_norm
        FROM sq, g""",
    "softmax": with_("emb_p") + "SELECT vec_id, idx, round(p, 6) AS p FROM emb_p",
    "topk_per_group": with_("emb_top") + "SELECT vec_id, idx, round(p, 6) AS p, rank_in_group FROM emb_top",
    "weighted_sample": with_("emb_top") + f"""
        SELECT vec_id, arg_max(idx, ln(p) - ln(-ln({_u(f"'{SEED}'", 'vec_id', '0', 'idx')}))) AS idx
        FROM emb_top GROUP BY vec_id""",
    "decode_roundtrip": "SELECT doc_id, md5(coalesce(text, '')) AS md5 FROM documents",
    "learn_bpe_merges": with_("learned") + """
        SELECT CAST(-k AS INTEGER) AS rank, CAST(split_part(sym, ' ', 1) AS INTEGER) AS left, CAST(split_part(sym, ' ', 2) AS INTEGER) AS right,
               CAST(256 - k AS INTEGER) AS token_id, CAST(cnt AS BIGINT) AS cnt FROM learned WHERE k <= 0""",
    "bpe_encode": with_("docs", "pre", "m0", "learned") + """
        SELECT d.doc_id, md5(d.text) AS md5, CAST(coalesce(t.n, 0) + 1 AS BIGINT) AS n,
               CAST(coalesce(t.s, 0) + 256 + (SELECT count(*) FROM learned WHERE k <= 0) AS BIGINT) AS id_sum
        FROM docs d LEFT JOIN (
          SELECT p.doc_id, sum(len(ids)) AS n, sum(list_sum(ids)) AS s FROM pre p JOIN (
            SELECT m0.piece, list_transform(string_split(l.sym[2:-2], '><'), lambda s: CAST(s AS INTEGER)) AS ids
            FROM m0 JOIN learned l ON l.k = m0.k) m ON m.piece = p.piece GROUP BY p.doc_id) t ON t.doc_id = d.doc_id""",
    "decode_words_roundtrip": "SELECT doc_id, md5(coalesce(text, '')) AS md5 FROM documents",
}

ORACLE_SQL |= _chain_sql({}, f"""upper(array_to_string(list_transform(list_filter(ids, lambda i: i < {EOT}), lambda i: printf('%02x', i)), ''))""")
try:
    _own = _tables(RANKED) | _rank_tables(rank_path(RANKED))
except ValueError:  # no vocabulary here: the byte-pair queries have no SQL
    _own = {}
if _own:
    _HEXED = "(SELECT coalesce(string_agg(r.h, '' ORDER BY x.k), '') FROM (SELECT unnest(ids) AS id, unnest(range(len(ids))) AS k) x JOIN ranks r ON r.id = x.id)"
    ORACLE_SQL |= {f"bpe_{k}": q for k, q in _chain_sql(_own, _HEXED).items()}
