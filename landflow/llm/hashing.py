"""Hashes over byte arrays with numpy, for use inside tasks."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            step_up, step_down = _U(pow(_BASE, m, 1 << 64)), _U(pow(_INVERSE, m, 1 << 64))
            self.up = np.concatenate([self.up, self.up * step_up])
            self.down = np.concatenate([self.down, self.down * step_down])
        return self.up[:n], self.down[:n]


POWERS = Powers()


class Rolling:
    """Hashes of any spans of one byte array, by prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = POWERS.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.up[:-1], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * _U(0xA0761D6478BD642F))

    def grams(self, width: int) -> np.ndarray:
        """The hash of every run of ``width`` bytes."""
        n = max(0, len(self.sums) - width)
        return mix((self.sums[width : width + n] - self.sums[:n]) * self.down[:n])


def trim_memory() -> None:
    """Give back what Arrow's and C's allocators keep for later: a worker shares its executor's memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def blocks(texts: list[str | None], most: int = 1 << 19):
    """(first row, bytes of each text) in blocks of about ``most`` bytes; null counts as empty."""
    trim_memory()
    held, size, first = [], 0, 0
    for k, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if text else b""
        held.append(data)
        size += len(data)
        if size >= most:
            yield first, held
            held, size, first = [], 0, k + 1
    if held:
        yield first, held
