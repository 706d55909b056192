"""SuperMinHash signatures of shingle sets, for whole batches at once.

Every element has a permutation of the slots and, for each rank in it, a random
value. A slot keeps the smallest rank + value over all elements. Slots are filled
rank by rank: once every slot of a document has a value, later ranks can only give
larger ones, so the document is done. Documents of many elements stop after two or
three ranks. As ranks of one element differ from slot to slot, estimates have less
variance than those of independent minima.
"""

from __future__ import annotations

import numpy as np

from kelpline.llm.wordhash import U64, mix

_SEED = U64(0x5851F42D4C957F2D)


def _permuted(rank: int, key: np.ndarray, slots: int) -> np.ndarray:
    """The slot of this rank in each element's permutation."""
    mask, fold = U64(slots - 1), U64((slots.bit_length() - 1) // 2 + 1)
    at = (U64(rank) + key) & mask
    for shift in (12, 24, 36):
        at = (at * (key >> U64(shift) | U64(1))) & mask
        at ^= at >> fold
        at = (at + (key >> U64(shift + 12))) & mask
    return at


def signatures(elements: np.ndarray, first: np.ndarray, slots: int) -> np.ndarray:
    """An array of (sets, slots) of 64-bit values: rank in the upper 12 bits, then the random value.

    elements: distinct hashes, set after set; first: where each set begins, and the end.
    slots: a power of two of at most 4096. The row of an empty set has only the largest value.
    An element's permutation is a chain of bijections of the slots' bits (add, multiply by an odd number, fold by a shift)
    whose constants are the element's hash bits; test_signatures holds its variance against that of shuffled tables.
    """
    n_sets = len(first) - 1
    none = U64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n_sets * slots, none, dtype=U64)
    owner = np.repeat(np.arange(n_sets, dtype=np.int64), np.diff(first))
    own = elements
    for rank in range(slots):
        if not len(own):
            break
        at = _permuted(rank, mix(own ^ _SEED), slots)
        value = (mix(own + U64((rank + 1) * int(_SEED) & 0xFFFFFFFFFFFFFFFF)) >> U64(12)) | (U64(rank) << U64(52))
        slot = owner * slots + at.astype(np.int64)
        open_ = out[slot] > value
        np.minimum.at(out, slot[open_], value[open_])
        undone = (out.reshape(n_sets, slots) == none).any(axis=1)
        if rank == 0 or not undone.all():
            keep = undone[owner]
            own, owner = own[keep], owner[keep]
    return out.reshape(n_sets, slots)


def band_hashes(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit hash for each band of `rows` slots; the band's number goes into it.

    Slots are shuffled first, as those of one band shouldn't be neighbours in the permutations' steps.
    """
    n, slots = sig.shape
    order = np.argsort(mix(np.arange(slots, dtype=U64) + _SEED), kind="stable")
    parts = sig[:, order].reshape(n, slots // rows, rows)
    out = np.broadcast_to(mix(np.arange(slots // rows, dtype=U64) + U64(rows << 20)), (n, slots // rows)).copy()
    for j in range(rows):
        out = mix(out * U64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return out
