"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model is compiled once in each worker into three machines: the normaliser (rewriting rules,
space to the mark U+2581, one mark in front of the text), the lexicon of pieces with their
costs, and byte fallback for characters that no piece has. Their composition with an input is
walked position by position; in the tropical semiring (costs add, the least sum wins) its
shortest path is the encoding.

For a unigram model a piece costs its negative score. For a byte-pair model the composed
machine remembers the last piece, and a pair of pieces costs infinity if the merges that built
them would have joined across their border first; one finite path is left, which is what
merging by rank gives. No piece of a usual model has a mark behind another character, so the
path falls apart at such places and equal parts of texts are walked once.

Decoding runs the machine backwards: pieces to characters, fallback pieces to bytes, marks to
spaces, the mark in front removed. Decoding gives the normalised text back exactly, but that
a U+2581 in the text comes back as a space.

Nulls encode to null, empty texts to no ids. Lone surrogates, which UTF-8 cannot hold, become
question marks. Work and memory of a text grow with its length. Repeated texts have equal ids.
An empty table gives an empty result.
"""

import array
import functools
import math
import re
import struct

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import ready

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
ROWS = 128  # texts encoded together
CACHED = 150_000  # parts of texts remembered in each of two generations
LONGEST = 64  # characters of a part that is remembered
FALLBACK = 1e6  # of a character without a piece in a unigram model, above any piece's cost
# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2


def fields(data):
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 2:
            size = varint()
            yield tag >> 3, data[at:at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, data[at:at + size]
            at += size


def read_model(data):
    """(pieces [(text, score, kind)], kind of model, normaliser options) of a model file."""
    found, kind, options = [], UNIGRAM, {"prefix": True, "squeeze": True, "map": b""}
    for number, value in fields(data):
        if number == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL, **dict(fields(value))}
            found.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            kind = dict(fields(value)).get(3, kind)
        elif number == 3:
            spec = dict(fields(value))
            options = {"prefix": bool(spec.get(3, 1)), "squeeze": bool(spec.get(4, 1)),
                       "map": spec.get(2, b"")}
    return found, kind, options


class Transducer:
    """The compiled machines of one model; ``rules`` rewrite strings before all else."""

    def __init__(self, data, rules=()):
        found, self.kind, options = read_model(data)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models can be compiled")
        if options["map"] and not rules:
            raise ValueError("the model has a compiled character map: give its rules as pairs")
        self.prefix, self.squeeze = options["prefix"], options["squeeze"]
        self.rules = dict(rules)
        self._rule = re.compile("|".join(map(re.escape, sorted(
            self.rules, key=len, reverse=True)))) if self.rules else None
        self.ids, self.cost = {}, []
        self.bytes, self.unknown = [0] * 256, 0
        self.out = []
        for i, (text, score, kind) in enumerate(found):
            self.cost.append(-score)
            self.out.append(text.replace(MARK, " ").encode())
            if kind in (NORMAL, USER):
                self.ids[text] = i
            elif kind == BYTE:
                self.bytes[int(text[3:5], 16)] = i
                self.out[i] = bytes([int(text[3:5], 16)])
            elif kind == UNKNOWN:
                self.unknown = i
                self.out[i] = " ⁇ ".encode()
            else:
                self.out[i] = b""
        self.fallback = all(self.bytes)
        self.longest = max(map(len, self.ids), default=1)
        self.text = {i: t for t, i in self.ids.items()}
        inner = any(MARK in t.lstrip(MARK) for t in self.ids)
        feed = any("\n" in t for t in self.ids)
        # Signs that no piece has behind a letter: there, too, every path has a border.
        signs = {c for c in map(chr, range(33, 127)) if not c.isalnum()} - {
            y for t in self.ids for x, y in zip(t, t[1:], strict=False) if x.isalpha()}
        letters = f"{MARK}*[^\\W\\d_]+(?=[{re.escape(''.join(sorted(signs)))}{MARK}\n]|\\Z)"
        self._part = re.compile(
            ".+" if inner else f"{MARK}*[^{MARK}]+|{MARK}+" if feed
            else f"{letters}|\n|{MARK}*[^{MARK}\n]+|{MARK}+", re.DOTALL)
        self.lexicon, self.beginnings = {}, None
        self.halves = self._halves() if self.kind == BPE else {}
        # Merging never reaches some pieces of a byte-pair model.
        self.usable = {t: i for t, i in self.ids.items()
                       if self.kind == UNIGRAM or i in self.halves}
        self.odd = self._odd()
        self.known, self.older, self.fits = {}, {}, {}

    def _sizes(self, start):
        """Sizes, longest first, of the pieces that may begin where the text has ``start``.

        ``start`` is up to three characters; remembered for each.
        """
        if self.beginnings is None:
            self.beginnings = {}
            for text in self.usable:
                if len(text) > 2:
                    self.beginnings.setdefault(text[:3], set()).add(len(text))
        sizes = sorted(self.beginnings.get(start, ()), reverse=True) if len(start) == 3 else []
        sizes += [k for k in (2, 1) if k <= len(start) and start[:k] in self.usable]
        self.lexicon[start] = sizes
        return sizes

    def merged(self, text):
        """What merging by rank leaves of a short text, and the two parts of the last merge."""
        parts, last = list(text), None
        while len(parts) > 1:
            best = min(((self.cost[j], k) for k in range(len(parts) - 1)
                        if (j := self.ids.get(parts[k] + parts[k + 1])) is not None),
                       default=None)
            if best is None:
                break
            k = best[1]
            last = parts[k], parts[k + 1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts, last

    def _halves(self):
        """The two pieces whose merge makes each piece, for pieces that merging reaches."""
        found = {}
        for text, i in self.ids.items():
            parts, last = self.merged(text)
            if len(parts) == 1:
                found[i] = (self.ids.get(last[0]), self.ids.get(last[1])) if last else None
        return found

    def _odd(self):
        """Pieces with a part that costs more than the whole; their borders are merged out."""
        found = set()
        for i in sorted(self.halves, key=lambda i: len(self.text[i])):
            halves = self.halves[i] or ()
            if any(h in found or self.halves.get(h) and self.cost[h] >= self.cost[i]
                   for h in halves):
                found.add(i)
        return found

    def fit(self, left, right):
        """Whether merging would leave the border between two pieces of a byte-pair model.

        From the last merge back to the first: while the two pieces at the border stood, a
        merge of them was possible, and would have come first, if it is cheaper than the merge
        that ended their time. Equal merges go from left to right.
        """
        key = left * len(self.cost) + right
        known = self.fits.get(key)
        if known is not None:
            return known
        a, b, limit, at_limit = left, right, math.inf, False
        good = None
        if left in self.odd or right in self.odd:
            good = self.merged(self.text[left] + self.text[right])[0] == [
                self.text[left], self.text[right]]
        while good is None:
            joined = self.ids.get(self.text[a] + self.text[b])
            if joined is not None:
                cost = self.cost[joined]
                if cost < limit or at_limit and cost == limit:
                    good = False
                    break
            own, other = self.halves.get(a), self.halves.get(b)
            if own is None and other is None:
                good = True
                break
            if other is None or own is not None and self.cost[a] > self.cost[b]:
                limit, at_limit, a = self.cost[a], False, own[1]
            else:
                limit, at_limit, b = self.cost[b], True, other[0]
        if len(self.fits) > 4 * CACHED:
            self.fits.clear()
        self.fits[key] = good
        return good

    def normalise(self, text):
        if self._rule:
            text = self._rule.sub(lambda m: self.rules[m[0]], text)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def merged_path(self, part):
        """The one finite path of a byte-pair model, found depth first, long pieces first.

        Each start of the part has one path too, so a position that leads nowhere does so
        whatever leads to it. Characters without a piece are given as minus one minus their code.
        """
        pieces, lexicon, fits, many = self.usable, self.lexicon, self.fits, len(self.cost)
        n, i, before = len(part), 0, None
        way, stack, dead = [], [], None
        options = None
        while i < n:
            if options is None:
                start = part[i:i + 3]
                options = iter(lexicon[start] if start in lexicon else self._sizes(start))
            for size in options:
                j = i + size
                piece = pieces.get(part[i:j]) if j <= n else None
                if piece is None or dead and j in dead:
                    continue
                if before is not None:
                    good = fits.get(before * many + piece)
                    if not (self.fit(before, piece) if good is None else good):
                        continue
                stack.append((i, before, options))
                way.append(piece)
                i, before, options = j, piece, None
                break
            else:
                if part[i] not in pieces and not (dead and i + 1 in dead):
                    stack.append((i, before, iter(())))
                    way.append(-1 - ord(part[i]))
                    i, before, options = i + 1, None, None
                else:
                    dead = dead or set()
                    dead.add(i)
                    i, before, options = stack.pop()
                    way.pop()
        return way

    def scored_path(self, part):
        """The path of least cost of a unigram model, position by position."""
        pieces, lexicon, costs = self.usable, self.lexicon, self.cost
        n = len(part)
        reach, last, back = [0.0] + [math.inf] * n, [None] * (n + 1), [0] * (n + 1)
        for i in range(n):
            start = part[i:i + 3]
            for size in lexicon[start] if start in lexicon else self._sizes(start):
                j = i + size
                piece = pieces.get(part[i:j]) if j <= n else None
                if piece is not None and reach[i] + costs[piece] < reach[j]:
                    reach[j], last[j], back[j] = reach[i] + costs[piece], piece, i
            if part[i] not in pieces and reach[i] + FALLBACK < reach[i + 1]:
                reach[i + 1], last[i + 1], back[i + 1] = reach[i] + FALLBACK, -1 - ord(part[i]), i
        way, j = [], n
        while j:
            way.append(last[j])
            j = back[j]
        return way[::-1]

    def shortest(self, part):
        """Ids on the shortest path through the composition with one part of a text."""
        way = self.merged_path(part) if self.kind == BPE else self.scored_path(part)
        if min(way) < 0:
            spelled = []
            for piece in way:
                if piece >= 0:
                    spelled.append(piece)
                elif self.fallback:
                    spelled.extend(self.bytes[b] for b in chr(-1 - piece).encode(
                        "utf-8", "replace"))
                else:
                    spelled.append(self.unknown)
            way = spelled
        return array.array("i", way).tobytes()

    def encode_all(self, texts):
        """Ids of each text as an array of 32-bit numbers."""
        split = [self._part.findall(self.normalise(t)) for t in texts]
        known, older = self.known, self.older
        found = {}
        for part in set().union(*split):
            if part not in known:
                found[part] = older[part] if part in older else self.shortest(part)
        known.update(found)
        out = [np.frombuffer(b"".join(map(known.__getitem__, parts)), np.int32)
               for parts in split]
        for part in found:
            if len(part) > LONGEST:
                del known[part]
        if len(known) > CACHED:
            self.older, self.known = known, {}
        return out

    def encode(self, text):
        """Ids of a text as an array of 32-bit numbers."""
        return self.encode_all([text])[0]

    def decode(self, ids):
        """Text of a sequence of ids."""
        raw = b"".join(map(self.out.__getitem__, ids.tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@functools.lru_cache(2)
def compiled(data, rules=()):
    return Transducer(data, rules)


def _model(spark, path):
    """The model's bytes as a broadcast; a model file is some megabytes at most."""
    ready(spark)
    return spark.sparkContext.broadcast(open(path, "rb").read())


def _encoded(machine, texts):
    """Ids of each text, None for what is no text."""
    there = [isinstance(t, str) for t in texts]
    found = iter(machine.encode_all([t for t, yes in zip(texts, there, strict=True) if yes]))
    return [next(found) if yes else None for yes in there]


def encoder(spark, model=MODEL, rules=()):
    """A column function from texts to their ids."""
    data = _model(spark, model)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(_encoded(compiled(data.value, rules), texts), index=texts.index,
                         dtype=object)

    return encode


def decoder(spark, model=MODEL, rules=()):
    """A column function from ids to texts."""
    data = _model(spark, model)

    @F.pandas_udf(T.StringType())
    def decode(ids: pd.Series) -> pd.Series:
        machine = compiled(data.value, rules)
        return pd.Series([None if i is None else machine.decode(np.asarray(i)) for i in ids],
                         index=ids.index, dtype=object)

    return decode


def encode_documents(docs, key="doc_id", text="text", model=MODEL, rules=()):
    """(key, ids, n_tokens, round_trip): round_trip says that decoding gives the text back.

    Encoding and decoding pass a text through Python once.
    """
    data = _model(docs.sparkSession, model)
    schema = T.StructType([
        docs.select(F.col(key)).schema[0], T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])

    def run(frames):
        machine = compiled(data.value, rules)
        for frame in frames:
            for at in range(0, len(frame), ROWS):
                part = frame.iloc[at:at + ROWS]
                texts = part[text].tolist()
                ids = _encoded(machine, texts)
                good = [None if i is None else machine.decode(i) == t.replace(MARK, " ")
                        for i, t in zip(ids, texts, strict=True)]
                size = [None if i is None else len(i) for i in ids]
                yield pd.DataFrame({
                    key: part[key].array, "ids": pd.Series(ids, dtype=object),
                    "n_tokens": pd.Series(size, dtype="Int64"),
                    "round_trip": pd.Series(good, dtype=object)})

    return docs.select(F.col(key), F.col(text)).mapInPandas(run, schema)
