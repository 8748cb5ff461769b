"""Whole batches of texts as one array of UTF-8 bytes, worked on by numpy without a loop over texts.

A word, line or shingle is known by a 64-bit fingerprint. Fingerprints are only compared within a document
or between two documents, where a false match has a chance of about n * n / 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Documents of one numpy batch together hold about so many bytes; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20
#: Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD = (1 << 64) - 1


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)


_BYTE = _table(7)
_PLACE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection, so nothing is merged)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


_POWERS = Powers()


def segment_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of data[starts:ends]: a polynomial over random byte values, taken from running sums."""
    _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POWERS.up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _POWERS.down[starts] + (ends - starts).astype(np.uint64))


def content_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of data[starts:ends] without algebra between positions: every eight bytes are mixed with their place.

    ``segment_hash`` is for windows that overlap; as a polynomial modulo 2**64 it gives some different texts of a regular
    build one value, whatever the base.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    sizes = ends - starts
    blocks = np.maximum((sizes + 7) >> 3, 1)
    first = np.cumsum(blocks) - blocks
    nth = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    left = np.minimum(np.repeat(sizes, blocks) - 8 * nth, 8).astype(np.uint64)  # bytes in a block
    kept = np.where(left == 0, np.uint64(0), np.uint64(_WORD) >> (np.uint64(64) - np.uint64(8) * np.maximum(left, np.uint64(1))))
    found = eight[np.repeat(starts, blocks) + 8 * nth] & kept
    mixed = mix(mix(found + _PLACE) ^ (nth.astype(np.uint64) * np.uint64(_BASE)))
    return mix(np.add.reduceat(mixed, first) + sizes.astype(np.uint64) * np.uint64(_BASE))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)


def word_mask(blanks: bytes = BLANKS) -> np.ndarray:
    mask = np.ones(256, bool)
    mask[list(blanks)] = False
    return mask


def encode(texts) -> list[bytes]:
    """UTF-8 of each text; null is empty. A lone surrogate, which Spark's strings cannot hold, becomes '?'."""
    return [b"" if t is None else t.encode("utf-8", "replace") for t in texts]


def batches(texts: list[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `limit` bytes each."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


class Octets:
    """Texts joined with one zero-word separator byte after each, so nothing reaches across two texts."""

    def __init__(self, texts: list[bytes], separator: bytes = b"\n") -> None:
        self.data = np.frombuffer(separator.join([*texts, b""]), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.sizes = sizes
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        self.n = len(texts)

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The text that each (sorted or not) byte position lies in."""
        return np.searchsorted(self.ends, at, side="left")

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of True, where separators must be False."""
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        return edge[::2], edge[1::2]


def counts(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Rows (or the sum of whole-number weights) of each of n owners."""
    return np.bincount(owner, weights, n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)


def shingles(words: np.ndarray, owner: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and owners of each text's distinct runs of `width` words; fewer words are one run as a whole."""
    m = len(words)
    if not m:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    have = counts(owner, n)
    first = np.cumsum(have) - have
    size = np.minimum(have, width)[owner]
    at = np.arange(m)
    starts = at[at + size <= (first + have)[owner]]
    out = np.full(len(starts), 0x51ED270B, np.uint64) + size[starts].astype(np.uint64)
    for k in range(width):
        some = k < size[starts]
        out = np.where(some, mix(out * np.uint64(3) + words[np.minimum(starts + k, m - 1)]), out)
    return distinct(out, owner[starts])


def distinct(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, value), ordered by owner, then value."""
    if not len(values):
        return values, owner
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], owner[new]
