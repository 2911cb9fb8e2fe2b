"""Vectorised access to many texts at once: one byte buffer, its documents,
words and 64-bit fingerprints, in numpy inside a task.

Words are maximal runs of anything but ASCII white space (``[^\\x20\\x09-\\x0D]+``).
"""

from __future__ import annotations

import numpy as np

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Odd multiplier of the polynomial over bytes, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)


def lower_ascii(buffer: np.ndarray) -> np.ndarray:
    return np.where((buffer >= 65) & (buffer <= 90), buffer + 32, buffer)


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One uint8 buffer with a line feed after each text, and the start of
    each text in it (one more start for the end)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), starts


def words(buffer: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and its document."""
    inside = ~_IS_SPACE[buffer]
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return begin, end, np.searchsorted(starts, begin, side="right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, by doubling."""
    out = np.empty(max(n, 1), np.uint64)
    out[0], have, step = 1, 1, base
    with np.errstate(over="ignore"):
        while have < n:
            more = min(have, n - have)
            out[have:have + more] = out[:more] * np.uint64(step)
            step = step * step & ((1 << 64) - 1)
            have += more
    return out


def prefix_sums(buffer: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums; with :func:`span_hash` any span hashes in
    constant time."""
    out = np.zeros(len(buffer) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[buffer] * powers(len(buffer)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the spans [begin, end), equal for equal bytes."""
    with np.errstate(over="ignore"):
        back = powers(len(sums), _INVERSE)
        return mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def shingle_hash(word: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of runs of ``width`` words inside a document, in text
    order, and their documents; a document of fewer words gives its whole
    sequence as one."""
    n = len(word)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        roll = word.copy()
        for k in range(1, width):
            roll = mix(roll)
            roll[:n - k] += word[k:]
    last = np.minimum(np.arange(n) + width - 1, n - 1)
    full = (doc[last] == doc) & (np.arange(n) + width <= n)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    length = np.diff(np.r_[first, n])
    short = length < width
    picks = [np.flatnonzero(full)]
    hashes, docs = roll[picks[0]], doc[picks[0]]
    if short.any():
        some = []
        for f, m in zip(first[short], length[short], strict=True):
            h = np.uint64(m)
            for w in word[f:f + m]:
                h = mix(np.array([h], np.uint64))[0] ^ w
            some.append(h)
        hashes = np.concatenate([hashes, mix(np.array(some, np.uint64))])
        docs = np.concatenate([docs, doc[first[short]]])
        order = np.argsort(docs, kind="stable")
        hashes, docs = hashes[order], docs[order]
    return mix(hashes), docs


def distinct(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints of each document, ascending within it."""
    if len(hashes) == 0:
        return hashes, doc
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    keep = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]
    return h[keep], d[keep]
