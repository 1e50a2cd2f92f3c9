"""Sets of word shingles as 64-bit hashes, and their HyperMinHash sketches, in numpy.

A sketch has 256 registers. A hash goes to the register of its first byte; a register keeps the smallest rest
it has met, stored as its number of leading zeros and the ten bits after the first one. Equal registers of two
sketches estimate the Jaccard similarity once the chance that different rests agree is taken off.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

REGISTERS, MANTISSA = 256, 10
ROWS, BANDS = 6, 42
_REST = 53
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64
_PRIME = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_PRIME))
_PLACES = mix(np.arange(1000, 1064, dtype=np.uint64)) | _U(1)


@functools.lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2^64."""
    n = 1 << bits
    up = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, _PRIME, np.uint64)]))
    down = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, pow(_PRIME, -1, 1 << 64), np.uint64)]))
    return up, down


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word: differences of one running polynomial hash."""
    raw = np.frombuffer(data, np.uint8)
    up, down = _powers(max(16, int(len(raw)).bit_length()))
    spelt = np.zeros(len(raw) + 2, bool)
    spelt[1:-1] = ~_BLANK[raw]
    edges = np.flatnonzero(spelt[1:] != spelt[:-1])
    begins, ends = edges[::2], edges[1::2]
    running = np.concatenate([[_U(0)], np.cumsum(_BYTES[raw] * up[: len(raw)])])
    return mix((running[ends] - running[begins]) * down[begins] + (ends - begins).astype(np.uint64)), begins


def shingle_sets(texts: list[str | None], width: int, slice_bytes: int = 1 << 20) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words is empty."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass").lower())
        size += len(held[-1]) + 1
        if size >= slice_bytes:
            yield from _sets(held, width)
            held, size = [], 0
    yield from _sets(held, width)


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    hashes, begins = word_hashes(b"\n".join(texts))
    limits = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.searchsorted(begins, limits)
    n = max(len(hashes) - width + 1, 0)
    combined = np.zeros(n, np.uint64)
    for k in range(width):
        combined += hashes[k : k + n] * _PLACES[k]
    combined = mix(combined)
    first = 0
    for last in cuts:
        count = last - first
        if count >= width:
            yield np.unique(combined[first : last - width + 1])
        elif count:
            whole = (hashes[first:last] * _PLACES[:count]).sum(dtype=np.uint64) + _U(count)
            yield mix(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
        first = last


def set_key(items: np.ndarray) -> bytes:
    """128-bit name of a set."""
    return blake2b(items.tobytes(), digest_size=16).digest()


def sketch(items: np.ndarray) -> np.ndarray:
    """Registers of a sorted set; 0 where empty. The first hash with a given first byte is the smallest."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(items):
        register = (items >> _U(56)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], register[1:] != register[:-1]]))
        rest = (items[first] & _U((1 << 56) - 1)) >> _U(56 - _REST)
        part, exponent = np.frexp(np.maximum(rest, _U(1)).astype(np.float64))
        zeros = _REST - exponent
        out[register[first]] = ((zeros + 1) << MANTISSA) | ((part * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return out


# Each register's own order of all registers: _TURN[k, j] is the turn at which register k asks register j.
_TURN = mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + _U(77)).reshape(REGISTERS, REGISTERS).argsort(1).argsort(1).astype(np.uint8)
_FACTORS = mix(np.arange(5000, 5000 + ROWS, dtype=np.uint64)) | _U(1)
_BAND = mix(np.arange(9000, 9000 + BANDS, dtype=np.uint64))


def bands(registers: np.ndarray) -> np.ndarray:
    """Keys of the bands. An empty register borrows from the first filled one in its own order of all registers."""
    source = np.arange(REGISTERS)
    empty, filled = np.flatnonzero(registers == 0), np.flatnonzero(registers)
    if len(empty):
        source[empty] = filled[_TURN[np.ix_(empty, filled)].argmin(1)]
    value = registers[source].astype(np.uint64) | (source.astype(np.uint64) << _U(16))
    rows = mix(value)[: ROWS * BANDS].reshape(BANDS, ROWS)
    return mix((rows * _FACTORS).sum(1, dtype=np.uint64) ^ _BAND).view(np.int64)


def chance(n: float, m: float) -> float:
    """Probability that registers of two disjoint sets of these sizes agree: equal zeros and equal mantissa."""
    zeros = np.arange(_REST)
    upper, lower = 2.0 ** -zeros, 2.0 ** -(zeros + 1.0)
    filled = [(1 - lower) ** (k / REGISTERS) - (1 - upper) ** (k / REGISTERS) for k in (n, m)]
    return float((filled[0] * filled[1]).sum() / (1 << MANTISSA))


def estimates(one: np.ndarray, many: np.ndarray, n: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected similarity of one sketch to many, and its standard error at a similarity of 0.8."""
    either = ((many > 0) | (one > 0)).sum(1)
    equal = ((many == one) & (one > 0)).sum(1)
    off = chance(n, float(np.median(sizes))) if len(sizes) else 0.0
    either = np.maximum(either, 1)
    return np.clip((equal / either - off) / (1 - off), 0, 1), np.sqrt(0.16 / either)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share ``percent`` of their union, counted on the full sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def links(sets: list[np.ndarray], sketches: np.ndarray, groups: list, percent: int) -> list[tuple[int, int]]:
    """Links that join the given groups of sets as far as any link does: none within what is joined already.

    Every pair from different groups is compared or meets one that was joined before. The estimate only passes
    over pairs five standard errors below the threshold; what remains is counted on the full sets.
    """
    names = {g: k for k, g in enumerate(dict.fromkeys(groups))}
    group = np.array([names[g] for g in groups])
    sizes = np.array([len(s) for s in sets])
    found = []
    for k in range(len(sets)):
        others = np.flatnonzero(group != group[k])
        others = others[others > k]
        near = 100 * np.minimum(sizes[others], sizes[k]) >= percent * np.maximum(sizes[others], sizes[k])
        others = others[near]
        if not len(others):
            continue
        similar, error = estimates(sketches[k], sketches[others], int(sizes[k]), sizes[others])
        for other in others[similar >= percent / 100 - 5 * error]:
            if group[other] != group[k] and linked(sets[k], sets[other], percent):
                found.append((k, int(other)))
                group[group == group[other]] = group[k]
    return found
