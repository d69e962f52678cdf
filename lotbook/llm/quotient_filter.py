"""Counting quotient filters of whole numbers of any fixed width, without loss.

A key is permuted by an invertible mixing of its bits. The permuted key's leading bits name the part of the key space it
lies in, the next ones are its quotient, and all the others its remainder. A filter holds the distinct keys of one part
in ascending order: how many remainders each quotient has, in unary; the remainders whole; a bit that tells counts of 1
from larger ones, and a counter for each of those, of one byte where the count allows. Permuted keys are spread evenly whatever the keys are, and filters of the same part are
merged by merging their sorted entries. Undoing the permutation gives the keys back.

Keys wider than 64 bits are held in several limbs, the first of which leads the order.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

from lotbook.llm.text_arrays import mix

Limbs = list[np.ndarray]
_ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_HEADER = struct.Struct("<IBI")


def widths(bits: int) -> list[int]:
    """Bits of each limb."""
    return [64] * ((bits - 1) // 64) + [(bits - 1) % 64 + 1]


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def pack(ids: Sequence[np.ndarray], width: int) -> Limbs:
    """Numbers of ``width`` bits side by side in one key."""
    limbs = [np.zeros(len(ids[0]), dtype=np.uint64) for _ in widths(len(ids) * width)]
    for place, value in enumerate(ids):
        limb, shift = divmod(place * width, 64)
        value = value.astype(np.uint64)
        limbs[limb] |= value << np.uint64(shift)
        if shift + width > 64:
            limbs[limb + 1] |= value >> np.uint64(64 - shift)
    return limbs


def unpack(limbs: Limbs, width: int, n: int) -> Limbs:
    """The ``n`` numbers that a key was packed from."""
    out = []
    for place in range(n):
        limb, shift = divmod(place * width, 64)
        value = limbs[limb] >> np.uint64(shift)
        if shift + width > 64:
            value |= limbs[limb + 1] << np.uint64(64 - shift)
        out.append(value & _mask(width))
    return out


def permuted(limbs: Limbs, bits: int) -> Limbs:
    """The keys with their bits mixed, each key to another one of the same width."""
    sizes = widths(bits)
    if len(sizes) == 1:
        half, mask = np.uint64((bits + 1) // 2), _mask(bits)
        value = limbs[0]
        for odd in _ODD:
            value = value * np.uint64(odd) & mask
            value = value ^ (value >> half)
        return [value]
    limbs = list(limbs)
    for _ in range(2):
        for i, size in enumerate(sizes):
            limbs[i] = limbs[i] ^ (mix(limbs[i - 1] + np.uint64(i + 1)) & _mask(size))
    return limbs


def restored(limbs: Limbs, bits: int) -> Limbs:
    """Undoes :func:`permuted`."""
    sizes = widths(bits)
    if len(sizes) == 1:
        half, mask = np.uint64((bits + 1) // 2), _mask(bits)
        value = limbs[0]
        for odd in reversed(_ODD):
            value = value ^ (value >> half)
            value = value * np.uint64(pow(odd, -1, 1 << 64)) & mask
        return [value]
    limbs = list(limbs)
    for _ in range(2):
        for i in reversed(range(len(sizes))):
            limbs[i] = limbs[i] ^ (mix(limbs[i - 1] + np.uint64(i + 1)) & _mask(sizes[i]))
    return limbs


def _order(limbs: Limbs) -> np.ndarray:
    return np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])


def tallied(limbs: Limbs, counts: np.ndarray | None = None) -> tuple[Limbs, np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, the sum of their counts (1 each if not given), and each key's place there."""
    n = len(limbs[0])
    order = _order(limbs)
    limbs = [limb[order] for limb in limbs]
    fresh = np.ones(n, dtype=bool)
    if n:
        fresh[1:] = np.logical_or.reduce([limb[1:] != limb[:-1] for limb in limbs])
    heads = np.flatnonzero(fresh)
    if counts is None:
        total = np.diff(np.append(heads, n))
    else:
        total = np.add.reduceat(counts[order], heads) if n else counts
    place = np.empty(n, dtype=np.int64)
    place[order] = np.cumsum(fresh) - 1
    return [limb[heads] for limb in limbs], total, place


def parts(limbs: Limbs, bits: int, part_bits: int) -> np.ndarray:
    """The part of the key space that each permuted key lies in."""
    size = widths(bits)[0]
    if not part_bits:
        return np.zeros(len(limbs[0]), dtype=np.int64)
    return (limbs[0] >> np.uint64(size - part_bits)).astype(np.int64)


def _bytes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value in as few whole bytes as hold them."""
    size = (width + 7) // 8
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _values(data: memoryview, n: int, width: int) -> tuple[np.ndarray, memoryview]:
    size = (width + 7) // 8
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :size] = np.frombuffer(data[: n * size], dtype=np.uint8).reshape(n, size)
    return wide.view("<u8").ravel().astype(np.uint64), data[n * size :]


def dumped(limbs: Limbs, counts: np.ndarray, bits: int, part_bits: int) -> bytes:
    """A filter of the ascending distinct permuted keys of one part."""
    sizes, n = widths(bits), len(counts)
    quotient_bits = min(sizes[0] - part_bits, max(n.bit_length() - 1, 0))
    rest = sizes[0] - part_bits - quotient_bits
    quotient = (limbs[0] & _mask(sizes[0] - part_bits)) >> np.uint64(rest) if rest < 64 else np.zeros(n, np.uint64)
    runs = np.zeros(n + (1 << quotient_bits), dtype=bool)
    runs[quotient.astype(np.int64) + np.arange(n)] = True
    more = counts > 1
    large = counts[counts >= 255]
    return b"".join([
        _HEADER.pack(n, quotient_bits, len(large)), np.packbits(runs).tobytes(),
        _bytes(limbs[0] & _mask(rest), rest), *[_bytes(x, s) for x, s in zip(limbs[1:], sizes[1:], strict=True)],
        np.packbits(more).tobytes(), np.minimum(counts[more], 255).astype(np.uint8).tobytes(),
        large.astype("<u8").tobytes()])


def loaded(data: bytes, part: int, bits: int, part_bits: int) -> tuple[Limbs, np.ndarray]:
    """The permuted keys and counts of a filter."""
    sizes = widths(bits)
    n, quotient_bits, n_large = _HEADER.unpack_from(data)
    view = memoryview(data)[_HEADER.size :]
    rest = sizes[0] - part_bits - quotient_bits
    n_runs = n + (1 << quotient_bits)
    runs = np.unpackbits(np.frombuffer(view[: (n_runs + 7) // 8], dtype=np.uint8), count=n_runs)
    view = view[(n_runs + 7) // 8 :]
    quotient = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
    first, view = _values(view, n, rest)
    if rest < 64:
        first |= quotient << np.uint64(rest)
    if part_bits:
        first |= np.uint64(part) << np.uint64(sizes[0] - part_bits)
    limbs = [first]
    for size in sizes[1:]:
        value, view = _values(view, n, size)
        limbs.append(value)
    more = np.unpackbits(np.frombuffer(view[: (n + 7) // 8], dtype=np.uint8), count=n).astype(bool)
    view = view[(n + 7) // 8 :]
    n_more = int(more.sum())
    larger = np.frombuffer(view[:n_more], dtype=np.uint8).astype(np.int64)
    larger[larger == 255] = np.frombuffer(view[n_more : n_more + 8 * n_large], dtype="<u8").astype(np.int64)
    counts = np.ones(n, dtype=np.int64)
    counts[more] = larger
    return limbs, counts
