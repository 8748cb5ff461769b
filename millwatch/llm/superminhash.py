"""SuperMinHash signatures of many sets at once.

Every element e has its own random permutation of the slots and random fractions; in round j it offers
``j + fraction`` to the j-th slot of its permutation, and a slot keeps its least offer. The permutations make the
slots of one set depend on each other, so estimates vary less than with independent hashes, most so for small sets.

Offers of a later round are larger than all of an earlier one, so rounds can be run side by side for all sets, and a
set stops as soon as all its slots are taken. A set far larger than the number of slots needs two to four rounds.
"""

from __future__ import annotations

import numpy as np

from millwatch.llm.octets import mix

SLOTS = 160
_FRACTION = np.uint64((1 << 32) - 1)


def signatures(values: np.ndarray, owner: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """(n, slots) unsigned 64-bit least offers: round in the high half, fraction in the low half.

    `values` are 64-bit element fingerprints, distinct within their `owner` (0 to n - 1). Sets without elements
    keep the largest value in all slots.
    """
    out = np.full(n * slots, np.iinfo(np.uint64).max, np.uint64)
    steps: list[np.ndarray] = []  # the swap partner of every live element in each round so far
    for j in range(slots):
        if not len(values):
            break
        draw = mix(values + np.uint64((0x9E3779B97F4A7C15 * (j + 1)) & ((1 << 64) - 1)))
        partner = (j + (((draw >> np.uint64(32)) * np.uint64(slots - j)) >> np.uint64(32))).astype(np.int16)
        slot = partner.copy()
        for i in range(j - 1, -1, -1):  # what earlier swaps have put where this one looks
            slot[slot == steps[i]] = i
        offer = np.uint64(j << 32) | (draw & _FRACTION)
        np.minimum.at(out, owner * slots + slot, offer)
        full = (out.reshape(n, slots) >> np.uint64(32) <= np.uint64(j)).all(axis=1)
        live = ~full[owner]
        steps.append(partner)
        if not live.all():
            values, owner = values[live], owner[live]
            steps = [s[live] for s in steps]
    return out.reshape(n, slots)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """(n, slots // rows) fingerprints of runs of `rows` slots, each band with its own."""
    n, slots = signature.shape
    count = slots // rows
    parts = signature[:, : count * rows].reshape(n, count, rows)
    out = np.broadcast_to(mix(np.arange(1, count + 1, dtype=np.uint64)), (n, count)).copy()
    for k in range(rows):
        out = mix(out * np.uint64(3) + parts[:, :, k])
    return out
