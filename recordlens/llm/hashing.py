"""64-bit hashes of the words of many texts at once, from sums over their bytes."""

from __future__ import annotations

import numpy as np

_SEED = 20240229
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_random = np.random.Generator(np.random.PCG64(_SEED))
# A random value for each byte; A-Z share those of a-z.
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_PLACES = _random.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _to_power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, np.uint64(base))
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def spans(classes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs of one non-zero class of bytes, none across two texts."""
    n = len(classes)
    new = np.empty(n + 1, bool)
    new[0] = new[n] = True
    np.not_equal(classes[1:], classes[:-1], out=new[1:n])
    new[offsets] = True
    cuts = np.flatnonzero(new)
    starts, ends = cuts[:-1], cuts[1:]
    kept = classes[starts] != 0
    starts, ends = starts[kept], ends[kept]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _raw(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial of each span: the sum of its bytes' random values times the powers of their places in it."""
    powers, inverses = _to_power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverses[starts]


def _finished(raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return mix(raw + lengths.astype(np.uint64) * _GOLDEN)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes, the same wherever the span stands; A-Z count as a-z.

    It is a polynomial in the bytes' random values modulo 2**64, mixed. Memory is 24 bytes for each byte of
    ``data``; ``run_hashes`` takes a long text piece by piece.
    """
    return _finished(_raw(data, starts, ends), ends - starts)


def run_hashes(data: np.ndarray, classes: np.ndarray, size: int) -> np.ndarray:
    """The hashes of all runs of one non-zero class of bytes in one text, looked at ``size`` bytes at a time.

    Pieces may end anywhere: the polynomial of a run that goes on is that of its first part plus that of the rest times the power of the part's length.
    """
    found, none = [], np.empty(0, np.uint64)
    kind, raw, length = 0, none, 0  # the run that the last piece ended in
    for at in range(0, len(data), size):
        piece = data[at : at + size]
        of_byte = classes[piece].astype(np.uint8)
        starts, ends, _ = spans(of_byte, np.array([0, len(piece)]))
        raws, lengths = _raw(piece, starts, ends), ends - starts
        if kind and of_byte[0] == kind:
            raws[:1] = raw + np.uint64(pow(_BASE, length, 1 << 64)) * raws[:1]
            lengths[0] += length
        elif kind:
            found.append(_finished(raw, np.array([length])))
        kind = int(of_byte[-1])
        last = len(raws) - (kind != 0)
        raw, length = (raws[last:], int(lengths[last])) if kind else (none, 0)
        found.append(_finished(raws[:last], lengths[:last]))
    if kind:
        found.append(_finished(raw, np.array([length])))
    return np.concatenate(found) if found else none


def gram_hashes(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``n`` consecutive words of one text, and their texts."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.full(count, np.uint64(n * int(_GOLDEN) % (1 << 64)))
    for i in range(n):
        total += words[i : i + count] * _PLACES[i]
    whole = owner[: count] == owner[n - 1 :]
    return mix(total[whole]), owner[:count][whole]


def long_gram_hashes(words: np.ndarray, n: int, size: int) -> np.ndarray:
    """Hashes of every ``n`` consecutive words of one text, made about ``size`` at a time."""
    ends = range(0, max(len(words) - n + 1, 0), size)
    made = [gram_hashes(words[a : a + size + n - 1], np.zeros(min(size + n - 1, len(words) - a), np.int64), n)[0] for a in ends]
    return np.concatenate(made) if made else np.empty(0, np.uint64)


def set_hash(words: np.ndarray) -> int:
    """A hash of a sorted array of distinct values."""
    return int(np.add.reduce(mix(words + _GOLDEN)) ^ np.uint64(len(words)))
