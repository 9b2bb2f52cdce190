"""Job parameters and the driver-side parameter checks."""

from __future__ import annotations

from dataclasses import dataclass, replace

from tokenweave.functions.common import TOKEN_ID_LIMIT

SPLITS = ("train", "val")
TOKEN_MODES = ("bytes", "ranks")
RANK_FILE_CONF = "spark.tokenweave.rank.file"


@dataclass(frozen=True)
class PackParams:
    """Parameters of one tokenise -> pack -> batch -> evaluate run.

    Defaults are the small-scale stand-ins used by the tests and the
    registered queries (shard of 150,000 byte tokens instead of 1e8, B=4,
    T=384 instead of 8, 1024, four readers).  The pipeline runs on lossless
    ids: UTF-8 bytes, or byte pairs of a given rank table (``RANKED``).  The word vocabulary (T7) is
    capped and serves counts and decoding only.
    """

    shard_size: int = 150_000
    B: int = 4
    T: int = 384
    ranks: int = 4
    tokens: str = "bytes"  # or "ranks"
    vocab_size: int = 257  # ids of the pipeline's tokens: 256 bytes and end-of-text
    word_vocab_size: int = 20_000  # words mode: id V-2 = unknown, V-1 = end-of-text
    total_batch: int = 98_304
    val_batches: int = 20
    block_size: int = 1024
    eval_every: int = 5
    checkpoint_every: int = 10
    top_k: int = 50
    num_sequences: int = 10
    new_tokens: int = 30  # that a generated sequence adds to its prompt
    seed: str = "42"
    bpe_merges: int = 256  # learned for the encoder that has an SQL twin
    vocabulary_merges: int = 1000  # learned without one
    stream_files: int = 4
    shard_prefix: str = "corpus"
    rank_file: str | None = None  # byte-pair ranks, read on the driver; None: see ``rank_path``

    @property
    def BT(self) -> int:
        return self.B * self.T

    @property
    def unk_id(self) -> int:
        return self.word_vocab_size - 2

    @property
    def eot_id(self) -> int:
        return self.word_vocab_size - 1

    @property
    def accum_steps(self) -> int:
        check_divisible(self.total_batch, self.B, self.T, self.ranks)
        return self.total_batch // (self.BT * self.ranks)

    def with_(self, **kw) -> "PackParams":
        return replace(self, **kw)

    def validate(self) -> "PackParams":
        if self.tokens not in TOKEN_MODES:
            raise ValueError(f"tokens must be one of {TOKEN_MODES}")
        if self.shard_size <= 0:
            raise ValueError("shard_size must be positive")
        if self.B <= 0 or self.T <= 0 or self.ranks <= 0:
            raise ValueError("B, T and ranks must be positive")
        if not 0 < self.vocab_size <= TOKEN_ID_LIMIT or not 2 < self.word_vocab_size <= TOKEN_ID_LIMIT:
            raise ValueError(f"a vocabulary has at most {TOKEN_ID_LIMIT} ids")
        check_seq_len(self.T, self.block_size)
        check_divisible(self.total_batch, self.B, self.T, self.ranks)
        return self


# The chain on byte pairs: 50,256 ranks and end-of-text; a token holds about two and a half bytes of the test tables.
RANKED = PackParams(tokens="ranks", vocab_size=50_257, shard_size=50_000, T=128, total_batch=32_768)


def rank_path(params: PackParams, spark=None) -> str:
    """The rank file: the parameter, else the session's setting, else the one of the installed vocabularies."""
    path = params.rank_file or (spark and spark.conf.get(RANK_FILE_CONF, None))
    if path:
        return path
    try:
        import public_tokenizers
    except ImportError:
        raise ValueError(f"no rank file: set PackParams.rank_file or {RANK_FILE_CONF}") from None
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def check_split(split: str) -> str:
    """only the two known splits exist."""
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, got {split!r}")
    return split


def check_divisible(total_batch: int, B: int, T: int, ranks: int) -> int:
    """the total batch must be a whole number of B*T*ranks."""
    if total_batch % (B * T * ranks) != 0:
        raise ValueError(
            f"total_batch {total_batch} is not divisible by B*T*ranks = {B * T * ranks}"
        )
    return total_batch // (B * T * ranks)


def check_seq_len(T: int, block_size: int) -> int:
    """F8: a sequence may not be longer than the block size."""
    if T > block_size:
        raise ValueError(f"sequence length {T} exceeds block size {block_size}")
    return T
