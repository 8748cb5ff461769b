"""Canonical, length-limited Huffman codes over numpy arrays.

Symbols are coded most significant bit first into independent blocks. Every EVERY symbols the length in bits of what
was coded since the last such checkpoint is kept, so a block's stretches can be decoded side by side.
"""

from __future__ import annotations

import numpy as np

LIMIT = 20
EVERY = 64


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Length of each symbol's code, 0 for symbols without a count: package-merge, optimal under the limit."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of this length")
    if len(used) <= 1:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    n, picked = len(order), []
    level = weights
    for _ in range(limit - 1):
        # pairs of the level below, merged into the symbols; symbols go first among equals
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.r_[weights, pairs]
        turn = np.argsort(both, kind="stable")
        picked.append(turn < n)
        level = both[turn]
    take = 2 * n - 2
    depth = np.zeros(n, np.int64)
    for is_symbol in reversed(picked):
        chosen = is_symbol[:take]
        here = int(chosen.sum())
        depth[:here] += 1
        take = 2 * (take - here)
    depth[:take] += 1
    out[order] = depth
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code, last = 0, 0
    per = np.bincount(lengths[order], minlength=1)
    at = 0
    for size in range(1, len(per)):
        code <<= size - last
        last = size
        codes[order[at : at + per[size]]] = code + np.arange(per[size])
        code += int(per[size])
        at += per[size]
    return codes


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bits of the ids, and the number of bits of each stretch of EVERY ids."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    total = int(end[-1]) if len(ids) else 0
    start = end - size
    # a code of at most 32 bits lies in two 32-bit words; its parts never overlap others', so sums join them
    room = 64 - (start & 31) - size
    wide = codes[ids].astype(np.uint64) << room.astype(np.uint64)
    word = start >> 5
    n = total // 32 + 2
    high = np.bincount(word, (wide >> np.uint64(32)).astype(np.float64), n)
    low = np.bincount(word + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    data = (high[:n] + low[:n]).astype(np.uint32).astype(">u4").tobytes()[: -(-total // 8)]
    marks = end[EVERY - 1 :: EVERY]
    if len(ids) % EVERY:
        marks = np.r_[marks, total]
    return data, np.diff(marks, prepend=0).astype("<u2")


class Decoder:
    """Table-driven: the next LIMIT bits give symbol and length at once."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.bits = int(lengths.max(initial=1))
        codes = canonical(lengths)
        used = np.flatnonzero(lengths)
        order = used[np.argsort(codes[used].astype(np.int64) << (self.bits - lengths[used]), kind="stable")]
        span = np.left_shift(1, self.bits - lengths[order].astype(np.int64))
        # a symbol and its length are one number, as every lookup is a step through memory
        self.known = np.ones(1 << self.bits, np.uint32)
        filled = int(span.sum())
        self.known[:filled] = np.repeat(order.astype(np.uint32) << 5 | lengths[order], span)

    def __call__(self, data: bytes, n: int, marks: np.ndarray) -> np.ndarray:
        """The n ids of a block."""
        return self.several([(data, n, marks)])

    def several(self, blocks: list[tuple[bytes, int, np.ndarray]]) -> np.ndarray:
        """The ids of blocks (bits, number of ids, bits of each stretch), one after another; their stretches go side by side."""
        raw = np.frombuffer(b"".join([*(data for data, _, _ in blocks), bytes(8)]), np.uint8)
        # 32 bits from every byte on
        word = np.ndarray(len(raw) - 3, ">u4", raw, strides=(1,)).astype(np.uint32)
        first = np.cumsum([0, *(8 * len(data) for data, _, _ in blocks)])
        bit = np.concatenate([a + np.cumsum(marks) - marks for a, (_, _, marks) in zip(first.tolist(), blocks, strict=False)]).astype(np.int64)
        sizes = np.full(len(bit), EVERY)
        ends = np.cumsum([len(marks) for _, _, marks in blocks])
        left = np.array([n for _, n, _ in blocks], np.int64)
        has = ends > np.append(0, ends[:-1])
        sizes[ends[has] - 1] = left[has] - EVERY * (np.diff(ends, prepend=0)[has] - 1)
        out = np.zeros((EVERY, len(bit)), np.uint32)
        shift, full = np.uint32(32 - self.bits), int(sizes.min(initial=EVERY))
        live = slice(None)
        for k in range(EVERY):
            if k >= full:
                live = np.flatnonzero(sizes > k)
            b = bit[live]
            look = self.known[word[b >> 3] << (b & 7).astype(np.uint32) >> shift]
            out[k, live] = look >> np.uint32(5)
            bit[live] = b + (look & np.uint32(31))
        # stretches that end early end their block
        return out.T[np.arange(EVERY) < sizes[:, None]] if full < EVERY else out.T.ravel()
