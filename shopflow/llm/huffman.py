"""Length-limited canonical Huffman codes over integer ids, encoded and decoded with numpy.

Codes have at most ``MAX_BITS`` bits, so one table of 2**MAX_BITS entries decodes any code.  A block
keeps the bit offset of every ``STRIDE``-th id; decoding starts at all these checkpoints at once
and steps through them side by side.
"""

from __future__ import annotations

import numpy as np

MAX_BITS = 20
STRIDE = 128


def code_lengths(ids: np.ndarray, counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Best code lengths <= ``max_bits`` for ids with positive counts (package-merge)."""
    n = len(ids)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    if n == 1:
        return np.ones(1, dtype=np.int64)
    if n > 1 << max_bits:
        raise ValueError("more ids than codes of max_bits bits")
    order = np.lexsort((ids, counts))
    weights = counts[order].astype(np.int64)
    # level by level: each package is a pair of neighbours of the level below, merged with the leaves;
    # leaf_upto[level][k] = leaves among the first k items of that level
    leaf_flags = []
    items = weights
    for _ in range(max_bits - 1):
        flags = np.zeros(0, dtype=bool)
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([weights, pairs])
        flags = np.concatenate([np.ones(n, dtype=bool), np.zeros(len(pairs), dtype=bool)])
        at = np.argsort(merged, kind="stable")
        items, flags = merged[at], flags[at]
        leaf_flags.append(flags)
    lengths = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for flags in reversed(leaf_flags):
        leaves = int(flags[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[:take] += 1
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Codec:
    """Canonical code: ids sorted by (length, id) get consecutive code words."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, lengths = np.asarray(ids)[order].astype(np.int64), np.asarray(lengths)[order].astype(np.int64)
        self.bits = int(lengths.max()) if len(lengths) else 1
        steps = np.left_shift(1, self.bits - lengths)
        starts = np.concatenate([[0], np.cumsum(steps)[:-1]]).astype(np.int64) if len(lengths) else steps
        n = int(self.ids.max()) + 1 if len(lengths) else 1
        self.length_of = np.zeros(n, dtype=np.int64)
        self.code_of = np.zeros(n, dtype=np.uint64)
        self.length_of[self.ids] = lengths
        self.code_of[self.ids] = np.right_shift(starts, self.bits - lengths).astype(np.uint64)
        # decoding table: the next ``bits`` bits -> id and code length
        self.table_id = np.zeros(1 << self.bits, dtype=np.uint32)
        self.table_len = np.zeros(1 << self.bits, dtype=np.uint8)
        if len(lengths):
            used = int(steps.sum())
            self.table_id[:used] = np.repeat(self.ids, steps)
            self.table_len[:used] = np.repeat(lengths, steps)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bit stream (most significant bit first) and the bit offset of every STRIDE-th id."""
        if len(ids) == 0:
            return b"", np.zeros(0, dtype=np.int64)
        size = self.length_of[ids]
        if not size.all():
            raise ValueError("id without a code")
        end = np.cumsum(size)
        at = end - size
        window = self.code_of[ids] << (64 - size - (at & 31)).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words = np.zeros(int(end[-1] >> 5) + 2, dtype=np.uint64)
        where = word[first]
        words[where] += np.add.reduceat(window >> np.uint64(32), first)
        words[where + 1] += np.add.reduceat(window & np.uint64(0xFFFFFFFF), first)
        return words.astype(">u4").tobytes()[: -(-int(end[-1]) // 8)], at[::STRIDE]

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ids of a block."""
        if n == 0:
            return np.zeros(0, dtype=np.uint32)
        raw = np.frombuffer(payload + b"\0" * (16 + -len(payload) % 4), dtype=">u4").astype(np.uint64)
        pairs = (raw[:-1] << np.uint64(32)) | raw[1:]
        lanes = len(checkpoints)
        out = np.zeros((STRIDE, lanes), dtype=np.uint32)
        at = np.asarray(checkpoints, dtype=np.int64).copy()
        last = n - (lanes - 1) * STRIDE
        mask = np.uint64((1 << self.bits) - 1)
        for k in range(STRIDE if lanes > 1 else last):
            live = lanes if k < last else lanes - 1
            now = at[:live]
            shift = (64 - self.bits - (now & 31)).astype(np.uint64)
            code = ((pairs[now >> 5] >> shift) & mask).astype(np.int64)
            out[k, :live] = self.table_id[code]
            now += self.table_len[code]
        return out.T.reshape(-1)[:n]
