"""Sum-of-squares packing of tokenised documents into sequences of equal size.

A document is its token ids and an end token. Only documents longer than a sequence are cut, into
whole sequences and a rest. A whole sequence needs no packing; the other pieces are placed one by
one where the sum over gaps of the squared number of open sequences with that gap becomes smallest
(a new sequence counts as one with its whole length open).

1. One pass makes the pieces; they carry lengths and checksums, and ids only if asked for.
2. Pieces are dealt into groups of some ``GROUP`` rows, whatever their ids or texts, and each group
   is packed in a task, longest first. Sequences that are full are done; the pieces of the others
   are packed again, until that gains nothing. The pieces that then still lie in open sequences, a
   hundredth or so, are dealt into fewer groups in the next round. The last round has one group, of
   at most ``GROUP`` pieces, so no task ever holds more, and each round is a table of its own.

Nulls: a null text is empty and becomes the end token alone; a null id is kept. Equal rows are
pieces of their own. Ties between places go to the smallest gap, so a rerun on the same table gives
the same sequences. An empty table gives an empty result. Other columns are ignored.

The tokenizers this is for split texts before all else: at white space, which they drop, between
letters and marks, and at each digit. So a worker encodes a word once and remembers a bounded number
of words. For others, ``across_spaces=True`` encodes whole texts. Words of Latin letters that are new skip
the tokenizer's own steps before its model where these only put letters in lower case and map their bytes.
"""

import functools
import json
import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from tidegauge.llm.common import keep, ready

SIZE = 2048
END = 0
GROUP = 16384  # pieces packed in one task
WORDS = 1 << 19  # words of late that a worker remembers, and as many before
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LONGEST = 64  # bytes of a word that is remembered
# Letters of ASCII and of U+00C0 to U+00FF in UTF-8: each has one lower case letter and composes with none of them.
LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# Steps that do no more to a word of such letters than lower their case and map their bytes.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTES = {b: 0x100 + b - 0x5E for b in range(0x7F, 0xA1)} | {0xAD: 0x143}  # as ByteLevel maps those of no sign
PIECES = "doc_id {}, piece int, start long, length long, ids_crc32 long, ids {}"


def word_tokenizer():
    """Path of the public tokenizer that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def as_bytes(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def only_lowers(path):
    """Whether the tokenizer's steps before its model are such that a word of ``LATIN`` only gets lower case."""
    with open(path, encoding="utf-8") as file:
        steps = json.load(file)
    split = {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
    before = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
    return ((steps["normalizer"] or {}).get("normalizers") == NORMALIZERS and len(before) == 2
            and before[0] == split and before[1]["type"] == "ByteLevel"
            and not before[1]["add_prefix_space"] and not before[1]["use_regex"])


class Encoder:
    """Ids of texts by a tokenizer file, as little-endian numbers of four bytes."""

    def __init__(self, path, across_spaces=False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.across_spaces = across_spaces
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)).encode() or b"(?!)")
        self.mark = None
        # Ids with which words end, if the end of any word is told by its last id.
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = None
        if suffix and "ByteLevel" in repr(self.tokenizer.pre_tokenizer) and all(
                c + suffix in vocab for c in pre_tokenizers.ByteLevel.alphabet()):
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.latin = None
        if self.last is not None and only_lowers(path):
            self.latin = Tokenizer(self.tokenizer.model)
            self.latin.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.known, self.before = {}, {}  # words of late, and those known before

    def whole(self, texts):
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [as_bytes(e.ids) for e in found]

    def each(self, words):
        """Ids of each word: as one text, cut where the words end.

        A word of letters ends with an id that ends words. Others, and all if there is not one such id for each
        word, are one text with a digit between the words, cut where its id is. Words
        with that digit, and all if the cuts do not agree with the words, go one by one.
        """
        found = self.spelt(words)
        words = [w for w in words if w not in found] if found else words
        if not words:
            return found
        mark = self.whole(["0"])[0] if self.mark is None else self.mark
        self.mark = mark
        plain = [w for w in words if b"0" not in w] if len(mark) == 4 else []
        if plain:
            raw = self.whole([b" 0 ".join(plain).decode()])[0]
            ids = np.frombuffer(raw, "<u4")
            cuts = (4 * np.flatnonzero(ids == np.frombuffer(mark, "<u4"))).tolist()
            if len(cuts) == len(plain) - 1:
                found.update((w, raw[a:b]) for w, a, b in zip(
                    plain, [0, *(c + 4 for c in cuts)], [*cuts, len(raw)], strict=True))
        rest = [w for w in words if w not in found]
        found.update(zip(rest, self.whole([w.decode() for w in rest]), strict=True))
        return found

    def spelt_latin(self, words):
        """Ids of words of Latin letters, straight from the tokenizer's model."""
        if not words:
            return {}
        text = b" ".join(words).decode().lower()
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(BYTES)
        found = self.latin.encode_batch_fast([text], add_special_tokens=False)
        return self.cut(words, as_bytes(found[0].ids))

    def spelt(self, words):
        """Ids of the words of letters alone, if each has one id that ends words; else of none."""
        texts = [w.decode() for w in words] if self.last is not None else []
        kept = [(w, t) for w, t in zip(words, texts) if t.isalpha()]
        return self.cut([w for w, _ in kept], self.whole([" ".join([t for _, t in kept])])[0]) if kept else {}

    def cut(self, words, raw):
        """The ids of each word, if as many of all these ids end words; else of none.

        Each has such an id, as it has a letter; so as many ids as words are one for each.
        """
        cuts = (4 * np.flatnonzero(self.last[np.frombuffer(raw, "<u4")]) + 4).tolist()
        if len(cuts) != len(words) or cuts[-1] != len(raw):
            return {}
        return {w: raw[a:b] for w, a, b in zip(words, [0, *cuts[:-1]], cuts, strict=True)}

    def encode(self, text):
        if self.across_spaces:
            return self.whole([text])[0]
        words = text.encode("utf-8", "replace").split()  # at ASCII white space only
        if len(self.known) > WORDS:
            self.known, self.before = {}, self.known
        known = self.known
        found = list(map(known.get, words))
        at = [i for i, ids in enumerate(found) if ids is None]
        if at:
            new = {words[i] for i in at}
            self.learn(new)
            for i in at:
                found[i] = known[words[i]]
            for word in new:
                if len(word) > LONGEST:
                    del known[word]
        return b"".join(found)

    def learn(self, new):
        """Adds new words. Marks behind a letter of ASCII or ``LATIN`` are tokens of their own."""
        known, before = self.known, self.before
        special = self.special.search(b" ".join(new))
        cut, parts, latin, tails = [], set(), set(), set()
        for word in new:
            if word in before:
                known[word] = before[word]
                continue
            head = word.rstrip(MARKS)
            if special and self.special.search(word):
                head = word
                parts.add(head)
            elif self.latin and (head.isalpha() or LATIN.fullmatch(head)):
                head = head.lower()  # has the same ids and may be known
                latin.add(head)
            else:
                if not head[-1:].isalpha():
                    head = word
                parts.add(head)
            tail = word[len(head):]
            tails.add(tail)
            cut.append((word, head, tail))
        tails.discard(b"")
        ids = {b"": b""}
        unknown = self.recalled(latin, ids)
        ids.update(self.spelt_latin(unknown))
        parts.update(w for w in unknown if w not in ids)
        ids.update(self.each(self.recalled(parts | tails, ids)))
        for word, head, tail in cut:
            known[word] = ids[head] + ids[tail]
        for tail in tails:
            known[tail] = ids[tail]

    def recalled(self, words, ids):
        """The words that are not known; ids of the others go to ``ids``."""
        unknown = []
        for word in words:
            found = self.known.get(word) or self.before.get(word)
            if found:
                ids[word] = found
            else:
                unknown.append(word)
        return unknown


@functools.lru_cache(maxsize=2)
def encoder_of(path, across_spaces=False):
    """An encoder that the tasks of a worker have after one another, with the words it knows."""
    return Encoder(path, across_spaces)


def _cut(path, size, end, across_spaces, with_ids, frames):
    encoder = encoder_of(path, across_spaces)
    last = as_bytes([end])
    for frame in frames:
        rows = []
        for key, text in zip(frame["k"], frame["t"], strict=True):
            ids = encoder.encode(text if isinstance(text, str) else "") + last
            for piece, at in enumerate(range(0, len(ids), 4 * size)):
                part = ids[at:at + 4 * size]
                rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part),
                             np.frombuffer(part, "<i4") if with_ids else None))
        yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32",
                                          "ids"])


def pieces_of(docs, key="doc_id", text="text", tokenizer=None, size=SIZE, end=END,
              across_spaces=False, with_ids=False):
    """(key, piece, start, length, ids_crc32[, ids]) of each document."""
    ready(docs.sparkSession)
    # Ids travel as text: whole numbers beside nulls must not become floating ones.
    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"))
    cut = rows.mapInPandas(functools.partial(
        _cut, tokenizer or word_tokenizer(), size, end, across_spaces, with_ids),
        PIECES.format("string", "array<int>"))
    columns = [F.col("doc_id").cast(docs.schema[key].dataType).alias(key), "piece", "start",
               "length", "ids_crc32"]
    return cut.select(*columns, *["ids"] * with_ids)


def place(lengths, size):
    """Sequence of each piece, placed in the given order, and how full each sequence is.

    The change of the sum of squares is looked up for all gaps at once.
    """
    count = np.zeros(size + 1, np.int64)  # open sequences for each gap; full ones do not count
    open_ = [[] for _ in range(size + 1)]
    into, filled = np.empty(len(lengths), np.int64), []
    for i, n in enumerate(lengths):
        change = 1 - 2 * count[n:]
        change[1:] += 2 * count[1:size + 1 - n] + 1
        change[count[n:] == 0] = np.iinfo(np.int64).max
        change[-1] = 2 * count[size - n] + 1 if n < size else 0  # a new sequence
        gap = n + int(change.argmin())
        if gap == size:
            own = len(filled)
            filled.append(0)
        else:
            own = open_[gap].pop()
            count[gap] -= 1
        into[i] = own
        filled[own] += n
        if gap > n:
            count[gap - n] += 1
            open_[gap - n].append(own)
    return into, np.array(filled, np.int64)


def pack_group(lengths, size, tries=8):
    """(sequence, place in it, whether it is full) of each piece.

    Packs longest first; the pieces of sequences that did not become full are packed again as
    long as that makes fewer sequences.
    """
    lengths = np.asarray(lengths, np.int64)
    sequence, full = np.empty(len(lengths), np.int64), np.zeros(len(lengths), bool)
    todo, used, last = np.arange(len(lengths)), 0, None
    for _ in range(tries):
        order = todo[np.argsort(-lengths[todo], kind="stable")]
        into, filled = place(lengths[order].tolist(), size)
        if last is not None and len(filled) >= last:
            break
        done = filled[into] == size
        sequence[order], full[order] = used + into, done
        used += len(filled)
        todo, last = np.sort(order[~done]), int((filled < size).sum())
        if not len(todo):
            break
    order = np.lexsort((np.arange(len(lengths)), sequence))
    ahead = np.cumsum(lengths[order]) - lengths[order]
    first = np.ones(len(order), bool)
    first[1:] = sequence[order][1:] != sequence[order][:-1]
    offset = np.empty(len(lengths), np.int64)
    offset[order] = ahead - np.maximum.accumulate(np.where(first, ahead, 0))
    return sequence, offset, full


def _packed(turn, size, batches):
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    rows = pa.Table.from_batches(rows)
    sequence, offset, full = pack_group(rows["length"].to_numpy(), size)
    base = (1 << 60) + (turn << 54) + (TaskContext.get().partitionId() << 32)
    for name, values in (("sequence_id", base + sequence), ("offset", offset), ("_full", full)):
        rows = rows.append_column(name, pa.array(values))
    yield from rows.to_batches()


def _pack_round(rest, turn, size, groups):
    """One round: ``rest`` dealt evenly into groups, each packed by itself."""
    schema = rest.select("*", F.lit(0).cast("long").alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"), F.lit(True).alias("_full")).schema
    return keep(rest.repartition(groups).mapInArrow(
        functools.partial(_packed, turn, size), schema), "pack-round")


def pack(pieces, size=SIZE, group=GROUP):
    """``pieces``, a table with a column ``length``, with sequence_id and offset of each row."""
    ready(pieces.sparkSession)
    kept = keep(pieces, "pack-pieces")
    names = kept.columns
    done = [kept.filter(F.col("length") >= size).select(
        *names, F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))]
    rest, turn = kept.filter(F.col("length") < size), 0
    n = rest.count()
    while n:
        groups = -(-n // group)
        packed = _pack_round(rest, turn, size, groups)
        rest = packed.filter("not _full").select(*names)
        left = 0 if groups == 1 else rest.count()
        # Pieces most of which fill no sequence will not do so in another round either.
        last = groups == 1 or 2 * left > n
        done.append((packed if last else packed.filter("_full")).select(
            *names, "sequence_id", "offset"))
        n, turn = 0 if last else left, turn + 1
    return functools.reduce(lambda a, b: a.unionByName(b), done)


def pack_documents(docs, key="doc_id", text="text", size=SIZE, **options):
    """Pieces of all documents with their sequences; see ``pieces_of`` for the options."""
    return pack(pieces_of(docs, key, text, size=size, **options), size)


def sequences(packed):
    """(sequence_id, ids) of the packed pieces, which must have their ids."""
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(
        F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
