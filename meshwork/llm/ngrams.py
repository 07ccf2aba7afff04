"""Hashed byte n-grams of a batch of texts, vectorised over the batch.

What is summed here are whole numbers, so a text's sums depend on the text alone,
never on its neighbours in the batch or on where a long text is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multipliers of the bucket hash, one for each n.
_MIX = {1: 0x9E3779B1, 2: 0x85EBCA77, 3: 0xC2B2AE3D, 4: 0x27D4EB2F}
#: Odd base of the word hash and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
#: Bytes handled at once, so that a worker's arrays stay small.
SLICE_BYTES = 1 << 20


def slices(raws: list[bytes], most: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The texts in order, in lists of about ``most`` bytes (a longer text alone)."""
    held, size = [], 0
    for r in raws:
        if held and size + len(r) > most:
            yield held
            held, size = [], 0
        held.append(r)
        size += len(r)
    if held:
        yield held


def windows(raw: bytes, overlap: int, most: int = SLICE_BYTES) -> Iterator[bytes]:
    """A long text in windows that share ``overlap`` bytes with the next, so that each
    run of overlap + 1 bytes lies in exactly one of them."""
    for at in range(0, max(1, len(raw) - overlap), most):
        yield raw[at : at + most + overlap]


def joined(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of some texts, a blank before and after each text, and the
    places where each text's share begins (one more at the end)."""
    data = np.frombuffer(b" " + b"  ".join(raws) + b" ", np.uint8) if raws else np.zeros(0, np.uint8)
    sizes = np.fromiter((len(r) + 2 for r in raws), np.int64, len(raws))
    return data, np.concatenate([[0], np.cumsum(sizes)])


def buckets(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each byte; the last n - 1 bytes begin none."""
    wide = data.astype(np.uint32)
    code = wide[: max(0, len(wide) - n + 1)].copy()
    for k in range(1, n):
        code <<= np.uint32(8)
        code |= wide[k : len(wide) - n + 1 + k]
    code *= np.uint32(_MIX[n])
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    return code >> np.uint32(32 - bits)


def inner(bounds: np.ndarray, n: int) -> np.ndarray:
    """Starts and ends, in turns, of the n-grams that lie inside one text's share."""
    out = np.empty(2 * (len(bounds) - 1), np.int64)
    out[::2], out[1::2] = bounds[:-1], np.maximum(bounds[1:] - n + 1, bounds[:-1])
    return out


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of whole numbers values[bounds[i]:bounds[i + 1]], zero where that is empty."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, dtype=np.int64, out=total[1:])
    return total[np.minimum(bounds[1:], len(values))] - total[np.minimum(bounds[:-1], len(values))]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes above the blank."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = data > 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, equal for equal words."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = np.full(len(data), _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(powers * (data.astype(np.uint64) + np.uint64(1)), out=total[1:])
    back = np.full(len(data), _BACK, np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    return (total[ends] - total[starts]) * back[starts]
