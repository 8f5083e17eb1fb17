"""Two-stage suffix sorting of chosen positions of a byte string, by whole arrays.

Suffixes smaller than the suffix after them (type S) are sorted directly, by their first
``DEPTH`` bytes. The others (type L) are induced: scanning the sorted suffixes by buckets of
their first byte, the suffix before each goes to the next free place of its own bucket. The
order is right at least to the depth of the direct sort, which is all that common prefixes up
to that depth need.
"""

import numpy as np

DEPTH = 56
SLICE = 1 << 13  # positions compared together; what stands there fits into a core's cache


def words_at(data):
    """A view of the eight bytes from each position as one number, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(DEPTH + 16, np.uint8)])
    return np.ndarray((len(data) + DEPTH + 8,), ">u8", padded, strides=(1,))


def goes_on(words, at, begin, end):
    """For each position but the first, whether the bytes from begin to end after it are those after the one before.

    Bytes of the word in which ``begin`` lies count too: callers know them to be equal or do not care.
    """
    rows = np.ndarray((len(words) - DEPTH,), f"V{DEPTH}", words.base, strides=(1,))
    whole, rest = divmod(end, 8)
    mask = np.frombuffer(b"\xff" * rest + b"\x00" * (8 - rest), np.uint64)
    same = np.ones(len(at) - 1, bool)
    for low in range(0, len(same), SLICE):
        some, found = rows[at[low:low + SLICE + 1]], same[low:low + SLICE]
        some = some.view(np.uint64).reshape(-1, DEPTH // 8)
        for k in range(begin // 8, whole):
            found &= some[1:, k] == some[:-1, k]
        if rest:
            found &= (some[1:, whole] ^ some[:-1, whole]) & mask == 0
    return same


def lexicographic(words, at):
    """Positions ``at`` in order of their first ``DEPTH`` bytes.

    The first word decides most of the order. Where all of a group of equal beginnings go on equally,
    which is what repeats do, the group is in order already. The others are sorted by their group and as
    many of the next bytes as fit into one number with it, and so on.
    """
    key = words[at].astype(np.uint64)
    order = np.argsort(key)
    at, key = at[order], key[order]
    rest, todo, depth = None, at, 8  # places that are not settled (all), what stands there, bytes in order
    while len(todo):
        new = np.ones(len(todo), bool)
        new[1:] = key[1:] != key[:-1]
        open_ = ~new
        open_[1:] &= ~goes_on(words, todo, depth, DEPTH)
        group = np.cumsum(new) - 1
        unsettled = np.zeros(len(todo), bool)
        unsettled[group[open_]] = True
        left = np.flatnonzero(unsettled[group])
        rest = left if rest is None else rest[left]
        if not len(left) or depth >= DEPTH:
            break
        todo = todo[left]
        group = np.cumsum(new[left]) - 1
        bits = max(int(group[-1]).bit_length(), 8)
        bits += -bits % 8
        key = (group.astype(np.uint64) << np.uint64(64 - bits)) | (
            words[todo + depth].astype(np.uint64) >> np.uint64(bits))
        order = np.argsort(key)
        todo, key = todo[order], key[order]
        at[rest] = todo
        depth += 8 - bits // 8
    return at


def smaller_than_next(data):
    """Whether the suffix at each position is smaller than the next (type S).

    Equal bytes have the type of the first different pair after them; the end of the string
    is smaller than any byte.
    """
    n = len(data)
    after = np.concatenate([data[1:], np.zeros(1, np.uint8)])
    differs = data != after
    differs[-1:] = True
    # From each position the next one that differs from the byte after it.
    place = np.arange(n, dtype=np.int64 if n >= 1 << 31 else np.int32)
    next_different = np.minimum.accumulate(np.where(differs, place, place[-1:])[::-1])[::-1]
    types = data < after
    types[-1:] = False
    return types[next_different]


def sort_suffixes(data, chosen, words=None):
    """The chosen positions (a mask) in order of their suffixes.

    A chosen run is followed up to the next suffix of type S, so that every suffix to induce
    has the one after it in the order.
    """
    n = len(data)
    if not chosen.any():
        return np.zeros(0, np.int64)
    words = words_at(data) if words is None else words
    small = smaller_than_next(data)
    # Every position from a chosen one to the next of type S: those with a chosen one since
    # the last of type S before them.
    seen = np.cumsum(chosen, dtype=np.int64 if n >= 1 << 31 else np.int32)
    before = np.maximum.accumulate(np.where(small, seen, 0))
    inside = seen.copy()
    inside[1:] -= before[:-1]
    inside = inside > 0
    direct = np.flatnonzero(inside & small)
    direct = lexicographic(words, direct)
    induced = inside & ~small
    first = data[direct]
    cut = np.searchsorted(first, np.arange(257))
    waiting = [[] for _ in range(256)]
    if induced[-1]:
        waiting[data[-1]].append(np.array([n - 1]))
    order = []
    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waiting[c] = None
        waves = []
        while len(wave):
            waves.append(wave)
            before = wave[wave > 0] - 1
            wave = before[induced[before] & (data[before] == c)]
        bucket = np.concatenate([*waves, direct[cut[c]:cut[c + 1]]])
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (data[before] > c)]
        if len(before):
            to = data[before]
            by = np.argsort(to, kind="stable")
            before, to = before[by], to[by]
            edges = np.flatnonzero(np.diff(to)) + 1
            for part in np.split(before, edges):
                waiting[data[part[0]]].append(part)
    order = np.concatenate(order)
    return order[chosen[order]]


def first_owners(data, chosen, owner_of, length):
    """For each chosen position, in order: the smallest owner of an equal run of ``length`` bytes.

    ``owner_of`` gives the owners of an array of positions. Adjacent suffixes with a common
    prefix of at least ``length`` are of one group. ``length`` is at most ``DEPTH``.
    """
    at = np.flatnonzero(chosen)
    if not len(at):
        return at, np.zeros(0, np.int64)
    words = words_at(data)
    order = sort_suffixes(data, chosen, words)
    same = goes_on(words, order, 0, length)
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    owners = owner_of(order)
    least = np.minimum.reduceat(owners, starts)
    found = np.empty(len(data), np.int64)
    found[order] = np.repeat(least, np.diff(np.concatenate([starts, [len(order)]])))
    return at, found[at]
