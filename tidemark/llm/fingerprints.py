"""Rolling fingerprints over bytes and over words, with numpy; used inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_STEP = 1 << 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2 ** 64, grown on demand."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, _STEP)
        self.tables = [np.ones(1, np.uint64)] * 2

    def upto(self, n: int):
        while len(self.tables[0]) < n:
            self.tables = [np.concatenate([t, t * np.uint64(pow(b, len(t), _STEP))]) for b, t in zip(self.bases, self.tables)]
        return self.tables


_POWERS = [_Powers(base) for base in _BASES]


def prefix(symbols: np.ndarray, lane: int = 0) -> np.ndarray:
    """Sums from which :func:`windows` takes the fingerprint of any run of symbols."""
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * _POWERS[lane].upto(len(symbols) + 1)[0][:len(symbols)], out=sums[1:])
    return sums


def windows(sums: np.ndarray, starts: np.ndarray, lengths, lane: int = 0) -> np.ndarray:
    """Fingerprints of the runs that begin at ``starts``."""
    inverse = _POWERS[lane].upto(len(sums))[1]
    return mix((sums[starts + lengths] - sums[starts]) * inverse[starts])


#: Words of more bytes are hashed one by one.
_LONG = 64
#: What of eight bytes belongs to a word that has 0 to 8 bytes left.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def words(data: bytes, lane: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, fingerprint) of each run of bytes that are not ASCII white space.

    A word's length and its bytes, eight after eight, go through :func:`mix` in a chain; long words have their BLAKE2b hash. The two lanes
    are independent of each other.
    """
    d = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(d) + 2, np.int8)
    inside[1:-1] = ~_WHITE[d]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    size, odd = ends - starts, np.uint64(_BASES[lane])
    prints = mix(size.astype(np.uint64) * odd)
    eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([d, np.zeros(_LONG, np.uint8)]), 8)
    some = np.flatnonzero(size <= _LONG)
    for at in range(0, _LONG, 8):
        some = some[size[some] > at]
        if not len(some):
            break
        block = eights[starts[some] + at].view("<u8").ravel() & _MASKS[np.minimum(size[some] - at, 8)]
        prints[some] = mix((prints[some] ^ block) * odd)
    for i in np.flatnonzero(size > _LONG).tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]], digest_size=16).digest()
        prints[i] = int.from_bytes(digest[8 * lane:8 * lane + 8], "little")
    return starts, ends, prints


def grams(data: bytes) -> np.ndarray:
    """A 64-bit symbol for each run of eight bytes; runs of symbols stand for runs of bytes seven longer."""
    d = np.frombuffer(data, np.uint8)
    if len(d) < 8:
        return np.zeros(0, np.uint64)
    return mix(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(d, 8)).view("<u8").ravel())


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``width`` values, by doubling."""
    reach, out = 1, values
    while reach * 2 <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    return pick(out[:len(out) - (width - reach)], out[width - reach:]) if width > reach else out


def anchors(values: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the smallest of some ``width`` neighbouring values.

    Every run of ``width`` values holds one, and where runs are equal so are their places: the choice looks at content only.
    """
    if len(values) < width:
        return np.zeros(0, np.int64)
    least = sliding(values, width, np.minimum)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero(sliding(padded, width, np.maximum) == values)


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of ``total`` places lie in a run of ``length`` from one of ``starts``."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, total), -1)
    return np.cumsum(change[:-1]) > 0
