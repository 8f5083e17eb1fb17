"""Hashes of words and of runs of words, by whole arrays.

All hashes are 64-bit and the same on every machine and in every run.
"""

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_R = 0x5851F42D4C957F2D
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x):
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(n):
    """R**i and R**-i modulo 2**64 for i below n; R is odd, so it has an inverse."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_R, pow(_R, -1, 1 << 64))):
            with np.errstate(over="ignore"):
                _powers[k] = np.concatenate([np.ones(1, np.uint64), np.cumprod(
                    np.full(size - 1, base, np.uint64), dtype=np.uint64)])
    return _powers[0][:n], _powers[1][:n]


def sums(data):
    """Running sums from which ``span_hash`` has the hash of any span of the bytes."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def span_hash(sums_, starts, ends, size=None):
    """Hash of the bytes from starts to ends, wherever they stand; slices of places need the spans' size."""
    _, down = powers(len(sums_))
    size = np.uint64(size) if size else (ends - starts).astype(np.uint64)
    return mix((sums_[ends] - sums_[starts]) * down[starts] + size)


def joined(texts):
    """UTF-8 bytes of the texts, a line feed after each, and where each begins."""
    raw = [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=starts[1:])
    return np.frombuffer(b"\n".join(raw) + b"\n" if raw else b"", np.uint8), starts


def word_hashes(texts):
    """Hashes of all words of the texts in order, and the first word of each text."""
    data, starts = joined(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    gap = _SPACE[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[::2], edge[1::2]
    hashes = span_hash(sums(data), begin, end)
    return hashes, np.searchsorted(begin, starts)


def shingle_hashes(texts, width=5):
    """Hashes of all runs of ``width`` words, and the first run of each text.

    A text of fewer words, but at least one, is one run of all its words.
    """
    words, first = word_hashes(texts)
    n = np.diff(first)
    runs = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    offset = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=offset[1:])
    at = np.repeat(first[:-1] - offset[:-1], runs) + np.arange(offset[-1])
    found = np.zeros(len(at), np.uint64)
    size = len(words)
    long_enough = np.repeat(n >= width, runs)
    whole = at[long_enough]
    total = np.zeros(len(whole), np.uint64)
    for k in range(width):
        total = total * _ODD + words[whole + k]
    found[long_enough] = mix(total)
    for i in np.flatnonzero((n > 0) & (n < width)):
        own = 0
        for w in words[first[i]:min(size, first[i] + n[i])].tolist():
            own = (own * int(_ODD) + w + 1) & 0xFFFFFFFFFFFFFFFF
        found[offset[i]] = mix(np.array([own ^ int(n[i])], np.uint64))[0]
    return found, offset
