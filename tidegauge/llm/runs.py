"""Periodic runs of words: stretches that repeat with a period, found by suffix trees.

A run is a stretch of consecutive words whose smallest period is q, at least ``LEAST`` and 2 q
words long, that no neighbouring word continues.
1. Parts that can hold runs: all words of a run are in windows of six words that come again in it.
   A text without such a window has none; what such windows cover is cut into parts, and each part
   is cut again by its own windows. Nothing but the covered words is looked at further.
2. Ukkonen's suffix trees of a part and of its reversal. A tour notes the leaves in order and the
   depth of the node passed between two of them; the lowest common ancestor of two leaves is the
   least depth between them, found in constant time by a table of minima.
3. Lyndon roots: a run has a root that is the longest Lyndon word from its place, under one of the
   two orders of the words. Those lengths follow from the order of the leaves. Each root is
   extended to both sides by the common prefix with itself a period on, in both trees.

Each document is a row of its own, so a task holds one Arrow batch of texts and the trees of one
part; time and memory grow with a part's length, nearly or quite in proportion.

Nulls: a null text has no words. Empty texts and texts of fewer than ``LEAST`` words have no runs.
Equal texts have equal runs; repeated rows stay. An empty table gives an empty result. Columns other
than the id and the text are ignored. Words are split at ASCII white space.
"""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import ready

LEAST = 12  # words of a run
WINDOW = 6  # of a run of LEAST words or more, the windows of as many words come twice
ROUNDS = 8  # of cutting parts; what is left then is looked at as it is
SCANNED = T.StructType([
    *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("start", "length", "period")],
    T.StructField("collapsed", T.StringType())])
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def suffix_tree(symbols, kinds):
    """Ukkonen's suffix tree of numbers below ``kinds``, the last of which comes once.

    Returns (start, end, suffix, child): the label of the edge to each node as a range of the
    symbols, the suffix of each leaf (-1 for others; node 0 is the root), and {node * kinds +
    symbol: child}.
    """
    n = len(symbols)
    start, end, suffix, link, child = [0], [0], [-1], [0], {}
    node = edge = length = waiting = made = 0
    for i, symbol in enumerate(symbols):
        waiting += 1
        unlinked = 0
        while waiting:
            if not length:
                edge = i
            key = node * kinds + symbols[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i)
                end.append(n)
                suffix.append(made)
                link.append(0)
                made += 1
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                at = start[below]
                span = end[below] - at
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                if symbols[at + length] == symbol:
                    if unlinked:
                        link[unlinked] = node
                    length += 1
                    break
                middle = len(start)
                child[key] = middle
                start += (at, i)
                end += (at + length, n)
                suffix += (-1, made)
                link += (0, 0)
                made += 1
                start[below] = at + length
                child[middle * kinds + symbols[at + length]] = below
                child[middle * kinds + symbol] = middle + 1
                if unlinked:
                    link[unlinked] = middle
                unlinked = middle
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return start, end, suffix, child


class Extensions:
    """Common prefixes of suffixes of numbers from 1 on, by the tree of ``symbols`` and an end 0."""

    def __init__(self, symbols):
        n, kinds = len(symbols), max(symbols) + 1
        start, end, suffix, child = suffix_tree([*symbols, 0], kinds)
        key = np.fromiter(child.keys(), np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(key)
        self.ends = np.zeros(len(start), bool)
        self.ends[key[key % kinds == 0] // kinds] = True
        self.ends = self.ends.tolist()
        parent, below = key[order] // kinds, below[order]
        edges = np.searchsorted(parent, np.arange(len(start) + 1)).tolist()
        self.below, self.edges, self.suffix = below.tolist(), edges, suffix
        leaves, between = [], []
        below = self.below
        depth = [0] * len(start)
        ahead = [0]  # nodes to enter; ~node where the tour passes it between two children
        while ahead:
            v = ahead.pop()
            if v < 0:
                between.append(depth[~v])
                continue
            if suffix[v] >= 0:
                leaves.append(suffix[v])
                continue
            deep = depth[v]
            low, high = edges[v], edges[v + 1]
            for k in range(high - 1, low - 1, -1):
                c = below[k]
                depth[c] = deep + end[c] - start[c]
                ahead.append(c)
                if k > low:
                    ahead.append(~v)
        self.between = np.array(between, np.int64)
        self.rank = np.empty(n + 1, np.int64)
        self.rank[leaves] = np.arange(n + 1)

    def falling_rank(self):
        """Ranks of the suffixes where larger symbols come first, but for the end."""
        leaves, ahead, below, edges, suffix = [], [0], self.below, self.edges, self.suffix
        while ahead:
            v = ahead.pop()
            if suffix[v] >= 0:
                leaves.append(suffix[v])
                continue
            low, high = edges[v], edges[v + 1]
            if self.ends[v]:  # the end is the first child and comes first here too
                ahead += (*below[low + 1:high], below[low])
            else:
                ahead += below[low:high]
        rank = np.empty(len(self.rank), np.int64)
        rank[leaves] = np.arange(len(leaves))
        return rank

    def common(self, one, two):
        """Lengths of the common prefixes of the suffixes at ``one`` and ``two``, all different.

        Minima over ranges of two powers: the table's rows are made one after the other, and each
        pair is answered from the row of its range.
        """
        a, b = self.rank[one], self.rank[two]
        low, high = np.minimum(a, b), np.maximum(a, b)
        found = np.zeros(len(low), np.int64)
        if not len(low):
            return found
        level = np.frexp((high - low).astype(float))[1] - 1
        row = self.between
        for k in range(int(level.max()) + 1):
            mine = np.flatnonzero(level == k)
            found[mine] = np.minimum(row[low[mine]], row[high[mine] - (1 << k)])
            if len(row) > 1 << k:
                row = np.minimum(row[:-(1 << k)], row[1 << k:])
        return found


def next_smaller(rank):
    """For each place the next one of a smaller rank; the last place has the smallest."""
    out, stack = [0] * len(rank), []
    for i in range(len(rank) - 1, -1, -1):
        own = rank[i]
        while stack and rank[stack[-1]] > own:
            stack.pop()
        out[i] = stack[-1] if stack else i
        stack.append(i)
    return np.array(out[:-1], np.int64)


def runs_of_part(symbols, least=LEAST):
    """Runs (start, length, period) of numbers from 1 on, as a sorted array of rows."""
    n = len(symbols)
    forward, backward = Extensions(symbols), Extensions(symbols[::-1])
    found = []
    for rank in (forward.rank, forward.falling_rank()):
        period = next_smaller(rank.tolist()) - np.arange(n)
        at = np.flatnonzero(np.arange(n) + period < n)
        period = period[at]
        right = forward.common(at, at + period)
        left = np.zeros(len(at), np.int64)
        inner = np.flatnonzero(at > 0)
        left[inner] = backward.common(n - at[inner], n - at[inner] - period[inner])
        length = left + period + right
        good = (length >= 2 * period) & (length >= least)
        found.append(np.stack([at - left, length, period], axis=1)[good])
    return np.unique(np.concatenate(found), axis=0)


def parts_with_runs(ids, least=LEAST):
    """Ranges (begin, end) of a text that hold all its runs."""
    todo, found = [(0, len(ids), 0)], []
    while todo:
        begin, end, tries = todo.pop()
        size = end - begin
        if size < least:
            continue
        if tries == ROUNDS:
            found.append((begin, end))
            continue
        part = ids[begin:end]
        h = part[:size - WINDOW + 1].copy()
        for k in range(1, WINDOW):
            h *= FACTOR
            h += part[k:size - WINDOW + 1 + k]
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        if not same.any():
            continue
        edge = np.zeros(size + 1, np.int64)
        repeated = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
        edge[repeated] += 1
        edge[repeated + WINDOW] -= 1
        inside = np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]])
        change = np.flatnonzero(np.diff(inside))
        cuts = list(zip((change[::2] + begin).tolist(), (change[1::2] + begin).tolist(),
                        strict=True))
        if cuts == [(begin, end)]:
            found.append((begin, end))
        else:
            todo += [(a, b, tries + 1) for a, b in cuts]
    return sorted(found)


def runs_of(words, least=LEAST):
    """Runs (start, length, period) of a list of words, sorted, as an array of rows."""
    known = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.uint64)
    found = [np.zeros((0, 3), np.int64)]
    if len(known) < len(words):
        for begin, end in parts_with_runs(ids, least):
            symbols = np.unique(ids[begin:end], return_inverse=True)[1] + 1
            found.append(runs_of_part(symbols.tolist(), least) + np.array([begin, 0, 0]))
    return np.concatenate(found)


def without_repeats(words, runs):
    """The words without those that a run contains after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    stay = np.cumsum(edge[:-1]) == 0
    return [w for w, s in zip(words, stay.tolist(), strict=True) if s]


@F.pandas_udf(SCANNED)
def _scanned(texts: pd.Series) -> pd.DataFrame:
    out = []
    for text in texts:
        words = text.encode("utf-8", "replace").split() if isinstance(text, str) else []
        runs = runs_of(words)
        if len(runs):
            words = without_repeats(words, runs)
        out.append((runs[:, 0], runs[:, 1], runs[:, 2], b" ".join(words).decode()))
    return pd.DataFrame(out, columns=SCANNED.names)


def find_runs(docs, key="doc_id", text="text"):
    """(key, runs, collapsed) of each document.

    ``runs`` is array<struct<start, length, period>> by start, then period; ``collapsed`` is the
    text without the words that a run repeats, joined by single spaces.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(key), _scanned(F.col(text)).alias("_r"))
    return rows.select(key, F.arrays_zip("_r.start", "_r.length", "_r.period").cast(
        "array<struct<start:long,length:long,period:long>>").alias("runs"),
        F.col("_r.collapsed").alias("collapsed"))


@F.pandas_udf(T.StringType())
def made_periodic(ids: pd.Series, texts: pd.Series) -> pd.Series:
    """Texts of a tenth of the ids with their later words in a period; others as they are.

    With h the CRC-32 of the id in decimal and g = h // 10: where h % 10 is 0, the words from
    a = g % n on repeat those p words from a, p = 1 + (n - a) // (3 + g % 8).
    """
    out = []
    for i, text in zip(ids, texts, strict=True):
        if isinstance(i, str) and isinstance(text, str):
            g, rest = divmod(zlib.crc32(i.encode()), 10)
            words = [] if rest else text.encode("utf-8", "replace").split()
            if words:
                n = len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                turns = -(-(n - a) // p)
                text = b" ".join((words[:a] + words[a:a + p] * turns)[:n]).decode()
        out.append(text)
    return pd.Series(out, index=texts.index, dtype=object)


def digests(found, key="doc_id"):
    """Runs and collapsed texts as counts, the longest run and checksums."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
        F.lit("\n"))), "")
    rows = found.select(key, F.size("runs").cast("long").alias("n_runs"), longest.alias("_b"),
                        F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(
        key, "n_runs", (-F.col("_b.start")).alias("start"), F.col("_b.length").alias("length"),
        (-F.col("_b.period")).alias("period"),
        F.floor(1000 * F.col("_b.length") / -F.col("_b.period")).cast("long").alias(
            "exponent_milli"), "runs_sha256", "collapsed_sha256")
