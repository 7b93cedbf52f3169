"""Polynomial hashes modulo 2**64 for whole buffers of bytes at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Most bytes of one buffer.
CHUNK = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LINE = 10


def odd(seed: str) -> int:
    """An odd 64-bit number that follows from a name."""
    return int.from_bytes(hashlib.blake2b(seed.encode(), digest_size=8).digest(), "little") | 1


BASE = odd("base")
#: A random value for each byte.
BYTE = np.array([odd(f"byte {b}") for b in range(256)], dtype=np.uint64)
_POWERS: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS:
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(CHUNK + 1, b, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value[i] * base**i over each prefix."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers()[0][:len(values)], out=total[1:])
    return total


def _runs(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and plain sums of the maximal runs of bytes that are ``inside``; A-Z count as a-z."""
    edge = np.diff(np.concatenate([[False], inside[data], [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = prefix_sums(BYTE[_LOWER[data]])
    return start, end, (total[end] - total[start]) * powers()[1][start]


def _long_runs(text: bytes, inside: np.ndarray) -> np.ndarray:
    """Run hashes of one text, piece by piece; a run that a cut goes through is one run still."""
    sums: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    through = False
    for at in range(0, len(text), CHUNK):
        data = np.frombuffer(text, dtype=np.uint8, offset=at, count=min(CHUNK, len(text) - at))
        start, end, s = _runs(data, inside)
        n = end - start
        if through and len(start) and start[0] == 0:
            whole = int(sums[-1][-1]) + int(s[0]) * pow(BASE, int(sizes[-1][-1]), 1 << 64)
            sums[-1][-1], sizes[-1][-1] = whole & (1 << 64) - 1, sizes[-1][-1] + n[0]
            s, n = s[1:], n[1:]
        through = bool(len(end)) and end[-1] == len(data)
        if len(s):
            sums.append(s)
            sizes.append(n)
    if not sums:
        return np.zeros(0, dtype=np.uint64)
    return mixed(np.concatenate(sums) + np.concatenate(sizes).astype(np.uint64))


def run_hashes(texts: list[str | None], inside: np.ndarray) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes, in order, of its maximal runs of bytes that are ``inside`` (a
    table of 256, without the line feed); short texts are hashed together."""
    waiting: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        offsets = np.cumsum([0, *(len(t) + 1 for t in waiting)])
        start, end, s = _runs(np.frombuffer(bytes([_LINE]).join(waiting), dtype=np.uint8), inside)
        yield from np.split(mixed(s + (end - start).astype(np.uint64)), np.searchsorted(start, offsets[1:-1]))

    for t in texts:
        b = (t or "").encode("utf-8", "surrogatepass")
        if waiting and size + len(b) + 1 > CHUNK:
            yield from flush()
            waiting, size = [], 0
        if len(b) + 1 > CHUNK:
            yield _long_runs(b, inside)
        else:
            waiting.append(b)
            size += len(b) + 1
    if waiting:
        yield from flush()
