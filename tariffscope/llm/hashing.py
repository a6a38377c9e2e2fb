"""Vectorised words, word names and window names over many texts at once.

All names are unsigned 64-bit polynomial hashes (arithmetic modulo 2^64 over random byte values) with a
final mix, so equal content has the same name in every task without any exchange. Modulo a power of two
there are pairs of long words that collide whatever the base is (Thue and Morse's pattern and its complement, from 1,024
bytes on), so a word of more than LONG_WORD bytes is named by a cryptographic hash.
"""

from __future__ import annotations

import hashlib

import numpy as np

#: Bytes up to which a word's name is a polynomial: no structure short enough cancels more than some twenty bits.
LONG_WORD = 64
U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _RNG.integers(1, 2**64 - 1, 256, dtype=U) | U(1)
_BASE = U(0x9E3779B97F4A7C15)
_CHUNK = 1 << 20

#: White space that ends a word: the blank and code points 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the whole word."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = U(pow(int(_BASE), -1, 2**64))
_tables: list[np.ndarray] = [_powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)]


def _tables_for(n: int) -> list[np.ndarray]:
    if len(_tables[0]) <= n:
        _tables[:] = [_powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)]
    return _tables


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array with a line break after each text, and where each text starts (one more at the end)."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return np.frombuffer(b"\n".join([*texts, b""]) if texts else b"", np.uint8), offsets


def word_spans(buf: np.ndarray, is_space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~is_space[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_names(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The name of every word, from prefix hashes taken over stretches of about a megabyte."""
    out = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        first = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, first + _CHUNK, "right")))
        last = ends[upto - 1]
        power, inverse = _tables_for(int(last - first))
        prefix = np.zeros(last - first + 1, U)
        np.cumsum(_BYTE[buf[first:last]] * power[: last - first], out=prefix[1:])
        s, e = starts[at:upto] - first, ends[at:upto] - first
        out[at:upto] = mix((prefix[e] - prefix[s]) * inverse[s] + (e - s).astype(U))
        at = upto
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        digest = hashlib.blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def window_names(names: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """The name of each run of n consecutive names; ``seed`` picks an independent family."""
    if len(names) < n:
        return np.empty(0, U)
    factor = mix(np.array([seed * 2 + 1], U) * _BASE)[0] | U(1)
    # built by doubling: a window of 2k is two windows of k
    done, length = np.zeros(len(names) + 1, U), 0
    part, size, rest = names, 1, n
    while rest:
        if rest & 1:
            room = len(names) - length - size + 1
            step = U(pow(int(factor), size, 2**64))
            done = done[:room] * step + part[length : length + room]
            length += size
        rest >>= 1
        if rest:
            step = U(pow(int(factor), size, 2**64))
            part = part[:-size] * step + part[size:]
            size *= 2
    return mix(done)
