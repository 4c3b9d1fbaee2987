"""Words and word shingles of whole texts as arrays of stable 64-bit hashes, without a Python loop over words.

A word is a maximal run of letters and digits, compared in lower case (code point by code point).
"""

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, wraps

import numpy as np
import pyarrow as pa

SHINGLE = 5
_U = np.uint64
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def frugal(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on the batches of a task, which gives back what it freed when it ends.

    Workers go on to other stages; what their allocators keep for later would count as the executor's memory until then.
    """

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim is not None:
            trim(0)

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@cache
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it part of a word; the mixed value of its lower case."""
    points = np.arange(0x110000, dtype=np.uint64)
    is_word = np.zeros(0x110000, dtype=bool)
    lower = points.copy()
    for i in range(0x110000):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        if c.isalnum():
            is_word[i] = True
            small = c.lower()
            if len(small) == 1:
                lower[i] = ord(small)
    return is_word, mix((lower + _U(1)) * _U(_BASE))


_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for step in (_STEP, pow(_STEP, -1, 1 << 64)):
            p = np.full(size, step, dtype=np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        if size > 1 << 22:  # very long texts: not kept
            return made[0], made[1]
        _powers = made[0], made[1]
    return _powers


def words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and one-past-last character of each word; three empty arrays for a null or wordless text."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    is_word, value = _alphabet()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    inside = np.zeros(len(points) + 2, dtype=bool)
    inside[1:-1] = is_word[points]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return np.empty(0, np.uint64), edges, edges
    up, down = _power_tables(len(points) + 1)
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(value[points] * up[: len(points)], out=sums[1:])
    start, end = edges[::2], edges[1::2]
    return mix((sums[end] - sums[start]) * down[start]), start, end


def shingles(hashes: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``n`` words, in place; of all words if there are fewer; empty without words."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = out * _U(_STEP) + hashes[i : i + len(out)]
    return mix(out + _U(n))


def shingle_set(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """The distinct word shingles of a text, sorted."""
    return np.unique(shingles(words(text)[0], n))
