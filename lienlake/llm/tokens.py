"""Hashing of words and word windows with numpy, for functions that run on Arrow batches.

Texts are handled as UTF-8 bytes.  The white space of the contracts (space and
9 to 13) is ASCII and lower-casing A-Z touches ASCII only, so both can be done
on bytes.  A word's hash is a polynomial in its bytes modulo 2^64, read off a
running sum over the whole chunk, then mixed; a window's hash is a polynomial
in its words' hashes.
"""

from __future__ import annotations

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_BYTE = 0xD6E8FEB86659FD93
_WORD = 0xA0761D6478BD642F


def mix(x, salt: int = 0):
    """Scramble 64-bit hashes (a bijection for each salt)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((int(salt) * _ODD + _ODD) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse; the tables grow on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int):
        if n > self.n:
            self.n = max(n, 1 << 16, 2 * self.n)
            self.up, self.down = (np.cumprod(np.where(np.arange(self.n), np.uint64(b), np.uint64(1)), dtype=np.uint64)
                                  for b in (self.base, self.inverse))
        return self.up, self.down


class Hasher:
    """Word and window hashes of a chunk of documents (or lines)."""

    def __init__(self, lower: bool = True):
        self.codes = mix(np.arange(256, dtype=np.uint64), 7)
        if lower:
            self.codes[65:91] = self.codes[97:123]
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.bytes, self.words = Powers(_BYTE), Powers(_WORD)

    def tokens(self, buf: bytes):
        """Hash, first byte and end byte of every word of ``buf``."""
        a = np.frombuffer(buf, np.uint8)
        inside = np.zeros(len(a) + 2, np.int8)
        inside[1:-1] = ~self.space[a]
        edge = np.flatnonzero(np.diff(inside))
        starts, ends = edge[0::2], edge[1::2]
        up, down = self.bytes.upto(len(a) + 1)
        run = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(self.codes[a] * up[: len(a)], out=run[1:])
        return mix((run[ends] - run[starts]) * down[starts]), starts, ends

    def running(self, h):
        """Running sums from which the hash of any stretch of words is read."""
        up, _ = self.words.upto(len(h) + 1)
        run = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[: len(h)], out=run[1:])
        return run

    def stretch(self, run, first, end):
        """Hash of words first to end (arrays), before mixing."""
        _, down = self.words.upto(len(run))
        return (run[end] - run[first]) * down[first]


def chunks(texts: list, limit: int = 1 << 20):
    """Cut a list of byte strings into runs of about ``limit`` bytes (a longer text makes a run of its own)."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) + 1
        if size and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def joined(texts: list):
    """The texts of a chunk with a line feed between them, and where each begins."""
    starts = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=starts[1:])
    return b"\n".join(texts) + b"\n", starts


def byte_texts(column) -> list:
    """An Arrow string column as byte strings; null as empty."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def signed(h):
    """Hashes as Spark longs."""
    return h.view(np.int64)
