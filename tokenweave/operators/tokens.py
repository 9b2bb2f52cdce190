"""Vocabularies, encoding, decoding and the token range check.

Three token modes share one layout, ``(doc_id, n, ids ARRAY<INT>)`` with the
end-of-text id first in every document (T3):

* ``words`` - a vocabulary of the V-2 most frequent words, learned by a
  ``groupBy`` with map-side combine; id V-2 = unknown, V-1 = end-of-text.
* ``bytes`` - id = UTF-8 byte value, end-of-text = 256.
* ``bpe``   - byte-pair merges learned on Spark (see ``bpe.py``).

Encoding is one narrow pass: Spark splits the text into words on the JVM,
and an Arrow-batched ``mapInArrow`` helper does the dictionary lookup for a
whole batch at once (``pyarrow.compute.index_in``, a C++ hash lookup), so no
token-level shuffle is needed to put documents back together.  The
vocabulary it looks up is bounded by the parameter V and is shipped once per
executor as a broadcast variable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenweave.functions.common import TOKEN_ID_LIMIT, WORD_PATTERN, bounded_collect, ship_by_value
from tokenweave.session import cut_lineage

ship_by_value(__name__)

BYTE_EOT = 256
PIECES_PATTERN = WORD_PATTERN + r"|[ \t\r\n]+"  # words and the white space between them: together the whole text
TOKENS_SCHEMA = "doc_id bigint, n bigint, ids array<int>"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), 0)


# ---------------------------------------------------------------- vocabularies

def word_counts(docs: DataFrame) -> DataFrame:
    """Distinct words with their corpus counts (partial aggregation per task)."""
    return (docs.select(F.explode(words_of(F.col("text"))).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def word_vocab(docs: DataFrame, vocab_size: int) -> DataFrame:
    """``(token_id, word, cnt)`` for the V-2 most frequent words.

    Order is count descending, then word (binary order), so ties at the cut
    are deterministic.  A histogram of the counts tells which words can be
    among the first V-2, so only those (and the ties of the last) are sorted.
    """
    keep = vocab_size - 2
    if keep <= 0:
        raise ValueError("vocab_size must leave room for unknown and end-of-text")
    counts = cut_lineage(word_counts(docs))
    level = F.floor(F.log2("cnt") * 16).cast("int")
    total, lowest = 0, None
    # at most 16 * 63 rows
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        total, lowest = total + r["count"], r["level"]
        if total >= keep:
            break
    some = counts if lowest is None else counts.where(level >= lowest)
    top = some.orderBy(F.desc("cnt"), F.asc("word")).limit(keep)
    w = Window.orderBy(F.desc("cnt"), F.asc("word"))  # bounded: at most V-2 rows
    return top.select((F.row_number().over(w) - 1).cast("int").alias("token_id"), "word",
                      F.col("cnt").cast("bigint").alias("cnt"))


def byte_vocab(spark: SparkSession) -> DataFrame:
    """``(token_id, token_hex)``: 256 single bytes and end-of-text (empty)."""
    return spark.range(BYTE_EOT + 1).select(
        F.col("id").cast("int").alias("token_id"),
        F.when(F.col("id") < BYTE_EOT, F.lpad(F.hex(F.col("id")), 2, "0"))
        .otherwise(F.lit("")).alias("token_hex"))


# ---------------------------------------------------------------- lengths (JVM only)

def word_token_lengths(docs: DataFrame) -> DataFrame:
    """P1 in words mode without encoding: words + 1 end-of-text."""
    return docs.select("doc_id", (F.size(words_of(F.col("text"))) + 1).cast("bigint").alias("n"))


def byte_token_lengths(docs: DataFrame) -> DataFrame:
    """P1 in bytes mode: UTF-8 bytes + 1 end-of-text."""
    return docs.select("doc_id", (F.octet_length("text") + 1).cast("bigint").alias("n"))


# ---------------------------------------------------------------- encoding

def _with_eot(lens, values, eot):
    """Arrow list array of ``[eot] + values[slice]`` for every row (numpy, no loop); no ``eot`` if None."""
    import numpy as np
    import pyarrow as pa

    n = lens.astype(np.int64) + (eot is not None)
    offsets = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n, out=offsets[1:])
    if offsets[-1] >= 1 << 31:
        raise ValueError("a batch holds 2**31 ids or more; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    if eot is None:
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32))), n
    out = np.empty(int(offsets[-1]), dtype=np.int32)
    heads = offsets[:-1]
    out[heads] = eot
    body = np.ones(len(out), dtype=bool)
    body[heads] = False
    out[body] = values
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out)), n


def _words_kernel(vocab_bc, unk: int, eot: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        vocab = pa.array(vocab_bc.value, type=pa.string())
        for rb in batches:
            lists = rb.column(1)
            flat = lists.flatten()
            ids = pc.fill_null(pc.index_in(flat, value_set=vocab), unk)
            lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            arr, n = _with_eot(lens, ids.to_numpy(zero_copy_only=False), eot)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(n), arr],
                                             names=["doc_id", "n", "ids"])
    return run


def bytes_kernel(eot: int | None = BYTE_EOT):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from tokenweave.operators.packed import slices

        for rb in slices(batches, 1, 1):
            text = pc.cast(rb.column(1), pa.large_binary())
            lens = pc.binary_length(text).to_numpy(zero_copy_only=False)
            bufs = text.buffers()
            offs = np.frombuffer(bufs[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
            data = (np.frombuffer(bufs[2], dtype=np.uint8)[offs[0]:offs[-1]]
                    if bufs[2] is not None else np.empty(0, np.uint8))
            arr, n = _with_eot(lens, data.astype(np.int32), eot)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(n), arr],
                                             names=["doc_id", "n", "ids"])
    return run


def vocab_list(vocab: DataFrame, vocab_size: int) -> list[str]:
    """The vocabulary words in id order (at most V rows: a bounded collect)."""
    rows = bounded_collect(vocab.select("token_id", "word").orderBy("token_id"),
                           vocab_size, "word vocabulary")
    words = [r["word"] for r in rows]
    if [r["token_id"] for r in rows] != list(range(len(words))):
        raise ValueError("word vocabulary ids must be dense from 0")
    return words


def encode_words_bc(docs: DataFrame, words_bc, vocab_size: int) -> DataFrame:
    """Words-mode encode with an already broadcast vocabulary list."""
    src = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    return src.mapInArrow(_words_kernel(words_bc, vocab_size - 2, vocab_size - 1), TOKENS_SCHEMA)


def encode_words(docs: DataFrame, vocab: DataFrame, vocab_size: int) -> DataFrame:
    """T1/T3 words mode: ``(doc_id, n, ids)``; unknown words map to V-2."""
    bc = docs.sparkSession.sparkContext.broadcast(vocab_list(vocab, vocab_size))
    return encode_words_bc(docs, bc, vocab_size)


def _lossless_kernel(vocab_bc, eot: int, first_byte: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from tokenweave.operators.packed import list_slices

        vocab = pa.array(vocab_bc.value, type=pa.string())
        for rb in list_slices(batches, 1):
            lists = rb.column(1)
            flat = lists.flatten()
            word = pc.fill_null(pc.index_in(flat, value_set=vocab), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            known = word >= 0
            bounds = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = bounds - bounds[0]
            # the space between two known words of one text goes without saying
            implied = pc.equal(flat, " ").to_numpy(zero_copy_only=False).astype(bool)
            implied &= np.append(False, known[:-1]) & np.append(known[1:], False)
            edge = np.zeros(len(flat) + 1, bool)
            edge[bounds] = True
            implied &= ~edge[:-1] & ~edge[1:]
            data = flat.cast(pa.large_binary())
            offs = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
            own = np.frombuffer(data.buffers()[2], np.uint8) if data.buffers()[2] is not None else np.empty(0, np.uint8)
            width = np.where(known, 1, np.where(implied, 0, np.diff(offs)))
            ends = np.cumsum(width)
            at = np.arange(int(width.sum()), dtype=np.int64) - np.repeat(ends - width, width)
            is_word = np.repeat(known, width)
            values = np.repeat(word, width)
            values[~is_word] = own[(np.repeat(offs[:-1], width) + at)[~is_word]].astype(np.int64) + first_byte
            total = np.concatenate([[0], ends])
            arr, n = _with_eot(total[bounds[1:]] - total[bounds[:-1]], values, eot)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(n), arr], names=["doc_id", "n", "ids"])
    return run


def encode_words_lossless(docs: DataFrame, vocab: DataFrame, vocab_size: int) -> DataFrame:
    """Words of the vocabulary as their ids, everything else as bytes (id ``vocab_size`` + byte), end-of-text first.

    Two word ids in a row have one space between them; any other white space,
    and words outside the vocabulary with the space before them, are bytes.
    So the vocabulary's size decides how long a text gets, not what is kept.
    """
    if vocab_size + 256 > TOKEN_ID_LIMIT:
        raise ValueError(f"a vocabulary with bytes has at most {TOKEN_ID_LIMIT - 256} words")
    bc = docs.sparkSession.sparkContext.broadcast(vocab_list(vocab, vocab_size))
    src = docs.select("doc_id", F.regexp_extract_all(F.col("text"), F.lit(PIECES_PATTERN), 0).alias("pieces"))
    return src.mapInArrow(_lossless_kernel(bc, vocab_size - 1, vocab_size), TOKENS_SCHEMA)


def encode_bytes(docs: DataFrame, eot: bool = True) -> DataFrame:
    """T8 bytes mode: ids are the UTF-8 bytes, end-of-text 256 first (prompts have none: ``eot=False``)."""
    return docs.select("doc_id", "text").mapInArrow(bytes_kernel(BYTE_EOT if eot else None), TOKENS_SCHEMA)


# ---------------------------------------------------------------- decoding

def decode_bytes(seqs: DataFrame, ids: str = "ids", max_length: int | None = None,
                 drop_eot: bool = True) -> Column:
    """T5 bytes mode: ids -> UTF-8 text, all on the JVM (hex, unhex, decode)."""
    arr = F.col(ids)
    if max_length is not None:
        arr = F.slice(arr, 1, max_length)
    if drop_eot:
        arr = F.filter(arr, lambda x: x != BYTE_EOT)
    hexed = F.array_join(F.transform(arr, lambda x: F.lpad(F.hex(x), 2, "0")), "")
    return F.decode(F.unhex(hexed), "UTF-8")


def decode_words(tokens: DataFrame, words: list[str], vocab_size: int) -> DataFrame:
    """T5 words mode: ``(doc_id, text)`` of lossless word tokens (binary, the text's UTF-8 bytes).

    A space stands between two word ids that follow each other.
    """
    from tokenweave.operators.packed import decode, list_slices, pack

    # two tables in one: a word's bytes, and from vocab_size on single bytes; a space before a word that follows a word
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for rb in list_slices(batches, 1):
            lists = rb.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = bounds - bounds[0]
            word = flat < vocab_size - 2
            gap = word & np.append(False, word[:-1])
            gap[bounds[:-1][np.diff(bounds) > 0]] = False
            out = np.full(len(flat) + int(gap.sum()), vocab_size + ord(" "), np.int64)
            at = np.arange(len(flat)) + np.cumsum(gap)
            out[at] = flat
            ends = np.concatenate([[0], np.cumsum(1 + gap)])[bounds].astype(np.int32)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(out.astype(np.int32)))], names=["doc_id", "ids"])

    table = [w.encode() for w in words]
    table += [b""] * (vocab_size - len(table)) + [bytes([i]) for i in range(256)]
    spaced = tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>")
    return decode(pack(spaced, data="text"), table, "text")


# ---------------------------------------------------------------- checks

def assert_token_range(tokens: DataFrame, ids: str = "ids") -> DataFrame:
    """F2 enforce form: the job fails on any id outside [0, 2**16)."""
    ok = F.forall(F.col(ids), lambda x: (x >= 0) & (x < TOKEN_ID_LIMIT))
    # A filter (not a dropped column) so column pruning cannot remove the check.
    return tokens.filter(F.assert_true(ok, "an id does not fit the 16 bits of a shard token").isNull())


def token_range_report(tokens: DataFrame, ids: str = "ids") -> DataFrame:
    """F2 report form: documents, tokens and out-of-range ids, min and max id."""
    bad = F.size(F.filter(F.col(ids), lambda x: (x < 0) | (x >= TOKEN_ID_LIMIT)))
    return tokens.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.sum(F.size(ids)).cast("bigint").alias("n_tokens"),
        F.sum(bad).cast("bigint").alias("n_out_of_range"),
        F.min(F.array_min(ids)).cast("bigint").alias("min_id"),
        F.max(F.array_max(ids)).cast("bigint").alias("max_id"),
    )
