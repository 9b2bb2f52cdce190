"""Registered queries of the operators: thin functions that derive the contract's digest columns.

Every query reads whole tables.  ``ORACLE_SQL`` has the DuckDB SQL of those that SQL can express; the others
are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenweave.llm import chat, curriculum, decontam, langid, manifest, maxent, merkle, pii, qda, simhash, suffix, trie, warc
from tokenweave.functions.common import broadcast_if_small
from tokenweave.llm.common import crc_mod, shared_path, table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the contracts.
SIMHASH_SHINGLE, SIMHASH_RADIUS = 3, 2
QUALITY_THRESHOLD = 0.3
PROBE_CHAT = "</s>[INST] ok [/INST]"


def op1_merkle_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.fingerprint_successors(table(spark, sf, "documents"))


def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "pii")
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, text), ",")
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in pii.BASE],
        F.sha2(joined(F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    held_out = crc_mod(F.col("id"), 5) == 0
    stats = qda.document_statistics(table(spark, sf, "documents"))
    model = qda.fit(stats.where(~held_out), table(spark, sf, "labels"))
    return qda.score(stats, model).select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), "score",
        F.when(F.col("score") >= QUALITY_THRESHOLD, 1).otherwise(0).alias("predicted"))


def op4_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return maxent.score_texts(table(spark, sf, "documents"), crc_mod(F.col("doc_id"), 7) == 2)


def op5_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{PROBE_CHAT}'), (-7L, 1L, 'assistant', '{PROBE_CHAT}') "
                      "AS t(conv_id, turn, role, text)")
    back = chat.read_chats(chat.format_chats(turns.unionByName(probe)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(chat.loss_mask(F.col("formatted")), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontam.find_leaks(docs, table(spark, sf, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    mixed = curriculum.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "epochs", "first_position")
    return curriculum.training_order(mixed).drop("first_position")


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf, "documents"), keep_bytes=False)


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), path)
    return warc.read_archives(spark, path).select(
        F.col("page").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"))


def op10_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"), SIMHASH_SHINGLE, SIMHASH_RADIUS)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf, "conversations"))


def op12_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    net = langid.fit(docs.where(crc_mod(F.col("doc_id"), 4) != 2).select("text", "lang"))
    held_out = (crc_mod(F.col("id"), 4) == 2).alias("held_out")
    return langid.predict(docs, net).select(F.col("id").alias("doc_id"), held_out, "lang_pred", "score")


def op13_dataset_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Every leaf proved; where 5 divides the id's crc32 (a null id counts as empty text), the claim is a tampered row."""
    docs = table(spark, sf, "documents")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claim = F.when(crc_mod(F.col("doc_id"), 5) == 0, manifest.row_hash([*columns[:-1], lower]))
    rows = docs.select(F.col("doc_id").alias("id"), "source", manifest.row_hash(columns).alias("leaf"), claim.alias("claim"))
    made = manifest.build_manifest(rows, ["claim"])
    proved = manifest.prove(made, F.col("claim"), ["id"])
    subroots = broadcast_if_small(made.sources.select("tree", "subroot"), manifest.BROADCAST_NODES)
    return proved.join(subroots, "tree").select(
        F.col("id").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_merkle_fingerprints, op2_pii, op3_quality, op4_lm_scoring, op5_chat_format, op6_decontamination, op7_mixing, op8_suffix_dedup, op9_warc, op10_simhash_dedup,
    op11_prefix_trie, op12_language_id, op13_dataset_manifest)}


def _pii_sql() -> str:
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
             "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
             "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN "
            f"substr(reverse({digits}), i, 1)::INT ELSE (2 * substr(reverse({digits}), i, 1)::INT) % 10 + "
            f"(2 * substr(reverse({digits}), i, 1)::INT) // 10 END)) % 10 = 0")
    rotated = "substr(replace(hit, ' ', ''), 5) || substr(replace(hit, ' ', ''), 1, 4)"
    mod97 = (f"list_reduce(list_prepend(0, list_transform(string_split({rotated}, ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' "
             "THEN c::INT ELSE ascii(c) - 55 END)), lambda a, v: (a * CASE WHEN v < 10 THEN 10 ELSE 100 END + v) % 97) = 1")
    # a letter's value is at least 10, a digit's below, so the value alone tells how far to shift
    ok = {"email": "true", "ip": "len(list_filter(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) > 3 OR "
          "(length(ltrim(p, '0')) > 0 AND ltrim(p, '0')::INT > 255))) = 0",
          "card": f"length({digits}) BETWEEN 14 AND 19 AND {luhn}", "phone": f"length({digits}) BETWEEN 10 AND 15",
          "iban": mod97, "ssn": "near"}
    parts = []
    for rank, k in enumerate(pii.KINDS):
        p = plain.get(k.name, k.pattern.replace("(?:", "("))
        near = f"(?i)(^|[^A-Za-z])({k.words})([^A-Za-z]|$)"
        parts.append(f"""
SELECT doc_id, row_no, {rank} AS rank, '{k.name}' AS kind, pos AS s, pos + length(hit) AS e FROM (
 SELECT doc_id, row_no, hits[i] AS hit,
  list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: length(h))), 0) AS pos,
  regexp_matches(right(gaps[i], {pii.CONTEXT_CHARS}), '{near}') OR regexp_matches(left(gaps[i+1], {pii.CONTEXT_CHARS}), '{near}') AS near
 FROM (SELECT doc_id, row_no, gaps, hits, unnest(range(1, len(hits) + 1)) AS i FROM (
  SELECT doc_id, row_no, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS hits FROM d)))
WHERE {ok[k.name]}""")
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.BASE)
    base = ", ".join(f"'{k}'" for k in pii.BASE)
    one = "kind || ':' || s::VARCHAR || ':' || e::VARCHAR"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS t FROM documents),
spans AS ({' UNION ALL '.join(parts)})
SELECT d.doc_id, {counts},
 sha256(coalesce(string_agg({one}, ',' ORDER BY s, rank) FILTER (kind IN ({base})), '')) AS base_sha256,
 coalesce(string_agg({one}, ',' ORDER BY s, rank), '') AS spans
FROM d LEFT JOIN spans USING (row_no) GROUP BY d.row_no, d.doc_id"""


def _chat_sql() -> str:
    esc = lambda c: f"replace(replace({c}, '<', '<\\'), '[', '[\\')"
    return f"""
WITH t AS (
 SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL VALUES (-7, 0, 'user', '{PROBE_CHAT}'), (-7, 1, 'assistant', '{PROBE_CHAT}')),
n AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM t)
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 sum(length({esc('text')}) + CASE WHEN before IS NOT DISTINCT FROM role THEN {len(chat.NEXT)}
  ELSE {len(chat.TURN) + len(chat.TEXT) + len(chat.END)} + length({esc('role')}) END)::BIGINT AS formatted_chars
FROM n GROUP BY conv_id"""


_MIX_SQL = r"""
WITH RECURSIVE d AS (
 SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  md5(coalesce(doc_id::VARCHAR, text, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT source, n, (r - 1) % 3 + 1 AS weight,
  CASE WHEN r % 2 = 1 THEN 0.5 ELSE -0.5 END AS drift,
  row_number() OVER (ORDER BY 3.0 * n / ((r - 1) % 3 + 1), r) AS k FROM s),
-- sources by how early they are full: a source is capped if its share of what the fuller ones left is above its cap
f AS (SELECT *, (SELECT sum(n) FROM w)::BIGINT - coalesce(sum(3 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
  sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open FROM w),
m AS (SELECT min(k) FILTER (rest * weight <= 3 * n * open) AS first_open FROM f),
t AS (SELECT f.source, f.n, CASE WHEN first_open IS NULL OR k < first_open THEN (3 * f.n)::DOUBLE
   ELSE ((SELECT g.rest FROM f g WHERE g.k = first_open) * weight)::DOUBLE / (SELECT g.open FROM f g WHERE g.k = first_open) END AS target
  FROM f, m),
o AS (SELECT d.doc_id, d.size, t.n AS source_size, t.target, floor(t.target)::BIGINT AS words,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - d.size AS off
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
 CASE WHEN source_size = 0 THEN 0 ELSE words // source_size * size
  + greatest(0, least(size, words - words // source_size * source_size - off)) END::BIGINT AS taken,
 CASE WHEN size = 0 THEN 0 ELSE words // source_size
  + CASE WHEN words - words // source_size * source_size - off > 0 THEN 1 ELSE 0 END END::BIGINT AS epochs
FROM o"""

_WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
k AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM k)
SELECT page_id, payload_bytes, payload_digest,
 CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to FROM g"""

# Bytes as hex pairs: every window of 200 bytes by brute force.
_SUFFIX_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(coalesce(text, '')) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
w AS (SELECT r, i, md5(substr(h, (2 * i + 1)::BIGINT, 400)) AS k FROM (SELECT r, h, unnest(range(n - 199)) AS i FROM d WHERE n >= 200)),
hit AS (SELECT r, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
mark AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM hit),
run AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM mark),
span AS (SELECT r, min(i) AS s, max(i) + 200 AS e FROM run GROUP BY r, g),
cut AS (SELECT span.*, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS last FROM span),
kept AS (SELECT r, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS tail,
  string_agg(substr(h, (2 * last + 1)::BIGINT, (2 * (s - last))::BIGINT), '' ORDER BY s) AS front FROM cut JOIN d USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
 sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE front || substr(h, (2 * tail + 1)::BIGINT) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""



def _crc_sql(value: str) -> str:
    """crc32 of a number's decimal text, bit by bit: eight steps a byte."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, x), range(8)), lambda c, i: {step})"
    codes = f"list_transform(string_split({value}::VARCHAR, ''), lambda y: ascii(y)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, x: {byte}), 4294967295)"


def _manifest_sql() -> str:
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
    row = lambda text: "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fan = manifest.FAN
    tree = lambda leaves, keys: f"""
 SELECT {keys}, 0 AS lvl, i, h, n FROM {leaves}
 UNION ALL SELECT {keys}, lvl + 1, i // {fan}, sha256(string_agg(h, '' ORDER BY i)), (n + {fan - 1}) // {fan}
 FROM """  # noqa: E731
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, source, {row('text')} AS leaf,
  CASE WHEN doc_id IS NULL OR {_crc_sql('doc_id')} % 5 = 0 THEN {row(lower)} ELSE {row('text')} END AS claim FROM documents),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS t, n FROM (SELECT source, count(*) AS n FROM d GROUP BY source)),
l AS (SELECT d.doc_id, d.leaf AS h, d.claim, s.t, s.n, row_number() OVER (PARTITION BY s.t ORDER BY d.doc_id NULLS FIRST, d.leaf) - 1 AS i
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
node AS ({tree('l', 't')}node WHERE n > 1 GROUP BY t, lvl, i // {fan}, n),
sub AS (SELECT t, h, (SELECT count(*) FROM s) AS n, t AS i FROM node WHERE n = 1),
top AS ({tree('sub', '-1 AS t')}top WHERE n > 1 GROUP BY lvl, i // {fan}, n),
-- the way up of every leaf: in its source's tree, then in the top tree
way AS (SELECT l.t, l.i, node.lvl AS step, node.t AS tree, node.lvl, l.i // ({fan} ** node.lvl)::BIGINT AS at
  FROM l JOIN (SELECT DISTINCT t, lvl, n FROM node) node ON node.t = l.t AND node.n > 1
 UNION ALL SELECT l.t, l.i, 1000 + top.lvl, -1, top.lvl, l.t // ({fan} ** top.lvl)::BIGINT
  FROM l, (SELECT DISTINCT lvl, n FROM top) top WHERE top.n > 1),
both_trees AS (SELECT t, lvl, i, h FROM node UNION ALL SELECT t, lvl, i, h FROM top),
run AS (SELECT w.t, w.i, row_number() OVER (PARTITION BY w.t, w.i ORDER BY w.step) AS step,
  coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < w.at), '') AS before,
  coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > w.at), '') AS after
  FROM way w JOIN both_trees b ON b.t = w.tree AND b.lvl = w.lvl AND b.i // {fan} = w.at // {fan} GROUP BY w.t, w.i, w.step, w.at),
fold AS (SELECT t, i, 0 AS step, claim AS v FROM l
 UNION ALL SELECT f.t, f.i, f.step + 1, sha256(r.before || f.v || r.after) FROM fold f JOIN run r ON r.t = f.t AND r.i = f.i AND r.step = f.step + 1),
folded AS (SELECT t, i, arg_max(v, step) AS v FROM fold GROUP BY t, i),
proof AS (SELECT t, i, sha256(string_agg(before || after, '' ORDER BY step)) AS p FROM run GROUP BY t, i),
root AS (SELECT h FROM top WHERE n = 1)
SELECT l.doc_id, l.h AS leaf, sub.h AS subroot, root.h AS root, coalesce(proof.p, sha256('')) AS proof_sha256, folded.v AS folded_root,
 folded.v = root.h AS verified
FROM l JOIN sub USING (t) JOIN folded ON folded.t = l.t AND folded.i = l.i LEFT JOIN proof ON proof.t = l.t AND proof.i = l.i, root"""


_TRIE_SQL = f"""
WITH t AS (SELECT conv_id AS c, code, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code) AS k FROM (
  SELECT conv_id, turn, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS code,
   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL)),
s AS (SELECT c, count(*) AS n, {_crc_sql('c')} % 4 AS h, c - c % 20 AS base FROM t GROUP BY c),
v AS (SELECT s.c, s.n, s.h, s.base, least(s.h, coalesce(b.n, 0)) AS taken FROM s LEFT JOIN s b ON b.c = s.base),
r AS (SELECT v.c, t.k AS d, t.code, t.words FROM v JOIN t ON t.c = v.base AND t.k <= v.h
 UNION ALL SELECT v.c, t.k - v.h + v.taken, t.code, t.words FROM v JOIN t USING (c) WHERE t.k > v.h),
p AS (SELECT c, d, words, md5(string_agg(code, '' ) OVER (PARTITION BY c ORDER BY d)) AS key FROM r
 UNION ALL SELECT c, 0, 0, '' FROM s),
q AS (SELECT *, lag(key) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS last FROM p),
node AS (SELECT d, key, min(up) AS up, min(c) AS m, count(*) AS n, min(words) AS w,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends FROM q GROUP BY d, key),
kid AS (SELECT d - 1 AS d, up AS key, count(*) AS k FROM node WHERE d > 0 GROUP BY d, up),
own AS (SELECT node.*, coalesce(k, 0) AS k FROM node LEFT JOIN kid USING (d, key)),
-- a node's ancestors are the prefixes of its smallest member
total AS (SELECT q.d, q.key, count(*) FILTER (o.k = 0) AS leaves, sum((o.n - 1) * o.w)::BIGINT AS saved
  FROM own o JOIN q ON q.c = o.m AND q.d <= o.d GROUP BY q.d, q.key)
SELECT o.m AS conv_id, o.d AS depth, x.m AS parent_conv_id, o.n AS n_convs, o.k AS n_children, leaves AS n_leaves, saved AS saved_tokens,
 o.ends AS ends_sha256
FROM own o JOIN total USING (d, key) LEFT JOIN node x ON x.d = o.d - 1 AND x.key = o.up"""


ORACLE_SQL: dict[str, str] = {
    "op2_pii": _pii_sql(),
    "op5_chat_format": _chat_sql(),
    "op7_mixing": _MIX_SQL,
    "op8_suffix_dedup": _SUFFIX_SQL,
    "op9_warc": _WARC_SQL,
    "op11_prefix_trie": _TRIE_SQL,
    "op13_dataset_manifest": _manifest_sql(),
}
