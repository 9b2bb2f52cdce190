"""Tiny sequential restatements of the reference's fold and loader (test oracles)."""

from itertools import cycle, islice


def fold_pieces(lengths, S):
    """Cut documents into shards in order: (shard, pos, doc, src, n) pieces.

    Same fold as the reference (fill the buffer, write it when full, carry the
    rest), extended so a remainder longer than a shard keeps cutting (Q1).
    """
    pieces, shard, count = [], 0, 0
    for doc, n in enumerate(lengths):
        src = 0
        while src < n:
            take = min(S - count, n - src)
            pieces.append((shard, count, doc, src, take))
            count += take
            src += take
            if count == S:
                shard, count = shard + 1, 0
    return pieces


def loader_batches(shard_lengths, B, T, P, rank, n):
    """The first ``n`` (shard, start) batches that a sequential loader serves to one rank.

    Starts of a shard are ``rank * BT`` and every ``P * BT`` after it; the first is served if its
    ``BT + 1`` tokens fit, a later one if the whole stride of ``P * BT + 1`` tokens does (Q5, Q6).
    The shards' starts form one epoch, which repeats.  None if no shard serves the rank.
    """
    BT = B * T
    epoch = [(shard, start) for shard, L in enumerate(shard_lengths)
             for start in range(rank * BT, L, BT * P)
             if start + (BT if start == rank * BT else BT * P) + 1 <= L]
    return list(islice(cycle(epoch), n)) if epoch else None
