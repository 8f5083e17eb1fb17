"""Exact removal of byte strings that an earlier document has, by suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts in a document of a smaller
id is removed. Equal windows of that length are found by two-stage suffix sorting and common
prefixes of adjacent suffixes (``suffixes``).

Spark brings equal windows together. In each window the smallest hash of its grams of ``GRAM``
bytes, the leftmost of equals, is the window's anchor; equal windows have equal anchors.
1. Anchors: each part of some documents hands on each of its anchors once. Those in two texts
   are repeated, all others have no partner and are done.
2. Contexts: of texts with repeated anchors, the windows of each such anchor, with the bytes
   they cover, go to a bucket. Equal windows have the same smallest gram of ``ROUTE`` bytes, whose
   hash gives the bucket; neighbours that share it travel as one run.
3. Each bucket sorts its suffixes and finds the smallest document of each window.
4. Windows found in a smaller document are joined into spans of their text.

An anchor that a tenth of all parts has is hot (a licence line, a common passage). Its windows are
first compared within their part, only the first of equals is handed on, and each goes to the bucket
of its own hash. So neither a passage in a third of all documents nor one with as many surroundings
meets in one task. The list of hot anchors is at most ten times the anchors of a part.

Copies of a whole text are one text of the smallest id; the others are removed whole.

Nulls: a null text is empty; null ids come after all others and do not remove each other. Rows
of one id do not remove each other. Texts below ``length`` bytes are left alone. An
empty table gives an empty result. Lone surrogates become question marks. ``length`` is from ``GRAM``
to the depth of the sort (32 to 56); others are refused.
"""

import functools
import hashlib
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidegauge.llm.common import discard, keep, ready, release, tasks
from tidegauge.llm.hashing import mix, span_hash, sums
from tidegauge.llm.suffixes import DEPTH, first_owners

LENGTH = 50
GRAM = 32  # bytes of an anchor: rarely repeated by chance
ROUTE = 20  # bytes of the gram by which windows find their bucket: longer runs meet
PART = 1_000_000  # bytes of text handled together
MOST = 1 << 16  # texts of a part, numbered by two bytes
BUCKET = 4_000_000  # bytes of all texts for each bucket
SLICE = 1 << 15  # windows hashed together; small enough for a core's cache
LAST = (1 << 63) - 1
MAP, LOCAL = -2, -1  # in place of a bucket
BITS = 1 << 24  # words of the filter of texts


def parts_of(frames, part, columns=("_g", "_t")):
    """Lists of rows with some ``part`` bytes of text."""
    held, size = [], 0
    for frame in frames:
        for row in zip(*[frame[c] for c in columns], strict=True):
            held.append(row)
            size += len(row[1])
            if size >= part or len(held) == MOST:
                yield held
                held, size = [], 0
    if held:
        yield held


def buffer(texts):
    """(bytes of the texts one after the other, start of each text and the end)."""
    raw = [bytes(t) for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=starts[1:])
    return np.frombuffer(b"".join(raw), np.uint8), starts


def window_mask(starts, length=LENGTH):
    """Positions from which a window of that length stays within its text."""
    good = np.zeros(starts[-1], bool)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= length:
            good[a:b - length + 1] = True
    return good


def anchors(data, good, length=LENGTH, gram=GRAM):
    """(positions of windows, position of the smallest gram of each, its hash)."""
    width = length - gram + 1
    places, found, hashes = [], [], []
    for low in range(0, len(data), SLICE):
        at = np.flatnonzero(good[low:low + SLICE])
        if not len(at):
            continue
        piece = data[low:low + SLICE + length]
        total = sums(piece)
        n = len(piece) - gram + 1
        h = span_hash(total, slice(0, n), slice(gram, gram + n), gram)
        key = (h & ~np.uint64(0xFFFFFF)) | np.arange(n, dtype=np.uint64)
        least, size = key, 1
        while size < width:
            step = min(size, width - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        pos = (least[at] & np.uint64(0xFFFFFF)).astype(np.int64)
        places.append(at + low)
        found.append(pos + low)
        hashes.append(h[pos])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(found), np.concatenate(hashes)


def in_order(h):
    """Places in order of ``h``, those of equal numbers in their own order."""
    order = np.argsort(h)
    sorted_ = h[order]
    same = sorted_[1:] == sorted_[:-1]
    tied = np.zeros(len(h), bool)
    tied[1:] |= same
    tied[:-1] |= same
    at = np.flatnonzero(tied)
    order[at] = order[at][np.lexsort((order[at], sorted_[at]))]
    return order


def part_id(keys):
    """An id of a part from the keys of its texts, whatever task makes it."""
    at = np.arange(1, len(keys) + 1, dtype=np.uint64)
    return int(mix(np.array([mix(keys.view(np.uint64) * (at | np.uint64(1))).sum()],
                            np.uint64)).view(np.int64)[0])


def part_anchors(rows, length):
    """(keys, text number and anchor hash of each distinct pair, in order of the hash)."""
    keys = np.array([r[0] for r in rows], np.int64)
    data, starts = buffer([r[1] for r in rows])
    _, pos, h = anchors(data, window_mask(starts, length), length)
    first = np.flatnonzero(np.diff(pos, prepend=-1))
    pos, h = pos[first], h[first]
    number = np.searchsorted(starts, pos, side="right") - 1
    order = in_order(h)  # texts stay in order
    number, h = number[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (number[1:] != number[:-1])
    return keys, number[new], h[new]


SAID = "bucket int, part long, h binary, number binary, many binary, keys array<long>, hs array<long>"


def anchor_entries(length, part, buckets, frames):
    """What parts say of their anchors, in rows of ``SAID``.

    Bucket ``MAP``: the part's id and the keys of its texts. Bucket ``LOCAL``: the anchors that
    two texts of the part have, for each such text. Other buckets: the anchors of the part,
    each once, with the number of its first text and whether others of the part have it.
    """
    columns = [c.split()[0] for c in SAID.split(", ")]
    for rows in parts_of(frames, part):
        keys, number, h = part_anchors(rows, length)
        if not len(h):
            continue
        me = part_id(keys)
        heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        sizes = np.diff(np.concatenate([heads, [len(h)]]))
        owner = keys[number]
        several = np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
        both = np.repeat(several, sizes)
        out = [(MAP, me, None, None, None, keys, None),
               (LOCAL, me, None, None, None, owner[both], short(h[both]).view(np.int64))]
        h, number = h[heads], number[heads]
        bucket = (h % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        out += [(int(bucket[some[0]]), me, h[some].astype("<u8").view(np.uint8).reshape(
                    -1, 8)[:, 3:].tobytes(), number[some].astype("<u2").tobytes(),
                 np.packbits(several[some]).tobytes(), None, None)
                for some in np.split(order, cuts)]
        yield pd.DataFrame(out, columns=columns)


def repeated_anchors(hot_from, group):
    """The anchors of a bucket that are in two texts: (part, numbers, hashes, hot)."""
    h, number, many, part = [], [], [], []
    for i, row in enumerate(group.itertuples()):
        h.append(np.frombuffer(row.h, np.uint8).reshape(-1, 5))
        number.append(np.frombuffer(row.number, "<u2"))
        many.append(np.unpackbits(np.frombuffer(row.many, np.uint8))[:len(number[-1])])
        part.append(np.full(len(number[-1]), i))
    whole = np.zeros((sum(map(len, h)), 8), np.uint8)
    whole[:, 3:] = np.concatenate(h)
    h = whole.view("<u8")[:, 0]
    number, many, part = map(np.concatenate, (number, many, part))
    order = np.argsort(h)
    heads = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0]))
    sizes = np.diff(np.concatenate([heads, [len(h)]]))
    good = (sizes > 1) | (np.maximum.reduceat(many[order], heads) > 0)
    pick = order[np.repeat(good, sizes)]
    hot = np.zeros(len(h), bool)
    hot[order] = np.repeat(sizes >= hot_from, sizes)
    ids = group["part"].to_numpy()
    pick = pick[np.argsort(part[pick], kind="stable")]
    cuts = np.flatnonzero(np.diff(part[pick])) + 1
    out = [(ids[part[some[0]]], number[some].astype(np.int32), h[some].view(np.int64), hot[some])
           for some in np.split(pick, cuts) if len(some)]
    return pd.DataFrame(out, columns=["part", "numbers", "hs", "hot"])


def short(h):
    """The 40 bits of an anchor's hash that are handed on, beside its bucket."""
    return (h >> np.uint64(24)) << np.uint64(24)


def runs_of(places, key):
    """(first, count) of the runs of neighbouring places with equal keys."""
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate(
        [[True], (np.diff(places) != 1) | (key[1:] != key[:-1])]))
    return new, np.diff(np.concatenate([new, [len(places)]]))


WINDOWS = ("bucket int, bytes binary, n binary, g binary, d binary, first binary, "
           "marks array<struct<g:long,d:long,first:long,n:long>>")


def contexts(length, part, buckets, shared_hot, frames):
    """Windows of repeated anchors, from rows (_g, _t, _d, hs) of texts and their anchors.

    Rows of ``WINDOWS``: for each bucket the windows with the bytes they cover. The windows of hot
    anchors that a smaller document of the part has are not handed on; they are marks, (g, d,
    first, count), which travel with one of the part's rows.
    """
    hot = shared_hot.value
    for rows in parts_of(frames, part, ("_g", "_t", "_d", "hs")):
        data, starts = buffer([r[1] for r in rows])
        g = np.array([r[0] for r in rows], np.int64)
        d = np.array([r[2] for r in rows], np.int64)
        places, pos, h = anchors(data, window_mask(starts, length), length)
        new, count = runs_of(places, pos)
        first, h = places[new], short(h[new])
        mine = np.searchsorted(starts, first, side="right") - 1
        own = np.concatenate([np.asarray(r[3], np.int64) for r in rows]).view(np.uint64)
        owner = np.repeat(np.arange(len(rows), dtype=np.uint64), [len(r[3]) for r in rows])
        listed = np.isin(mix(h ^ mix(mine.astype(np.uint64))), mix(own ^ mix(owner)))
        warm = listed & np.isin(h, hot)
        cold = listed & ~warm
        near, at, least = first_of_runs(data, first[warm], count[warm], d[mine[warm]], length)
        run = np.flatnonzero(warm)[near]
        done = least < d[mine[run]]
        gone, text = at[done], mine[run[done]]
        new, size = runs_of(gone, text)
        marks = [dict(zip(("g", "d", "first", "n"), m, strict=True)) for m in zip(
            g[text[new]].tolist(), d[text[new]].tolist(),
            (gone[new] - starts[text[new]]).tolist(), size.tolist(), strict=True)]
        far = np.zeros(len(data), bool)
        far[places[np.repeat(cold, count)]] = True
        windows_at, gram, key = anchors(data, far, length, ROUTE)
        head, many = runs_of(windows_at, gram)
        rest = at[~done]
        windows = span_hash(sums(data), rest, rest + length) if len(rest) else rest.astype(np.uint64)
        bucket = (np.concatenate([key[head], windows]) % np.uint64(buckets)).astype(np.int64)
        first = np.concatenate([windows_at[head], rest])
        count = np.concatenate([many, np.ones(len(rest), np.int64)])
        mine = np.searchsorted(starts, first, side="right") - 1
        if not len(first):
            continue
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        raw = data.tobytes()
        out = []
        for some in np.split(order, cuts):
            out.append((int(bucket[some[0]]), b"".join(
                raw[a:a + n + length - 1] for a, n in zip(first[some].tolist(),
                                                          count[some].tolist(), strict=True)),
                count[some].astype("<u2").tobytes(), g[mine[some]].tobytes(),
                d[mine[some]].tobytes(),
                (first[some] - starts[mine[some]]).astype("<u4").tobytes(), marks))
            marks = None
        yield pd.DataFrame(out, columns=["bucket", "bytes", "n", "g", "d", "first", "marks"])


def first_of_runs(data, first, count, owner, length):
    """For each window of the runs: (run, place in ``data``, smallest owner of an equal window).

    The bytes that the runs cover are put one after the other and their suffixes sorted.
    """
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none
    size = count + length - 1
    begin = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=begin[1:])
    shift = first - begin[:-1]
    if shift.any():
        data = data[np.arange(begin[-1]) + np.repeat(shift, size)]
    else:
        data = data[:begin[-1]]
    edge = np.zeros(begin[-1] + 1, np.int8)
    edge[begin[:-1]] += 1
    edge[begin[:-1] + count] -= 1
    chosen = np.cumsum(edge[:-1], dtype=np.int8) > 0
    run = np.repeat(np.arange(len(size)), count)  # of each window, in their order
    where = np.full(begin[-1], -1, np.int32)
    where[chosen] = run
    at, least = first_owners(data, chosen, lambda p: owner[where[p]], length)
    return run, at + shift[run], least


def covered(length, group):
    """The windows of a bucket that a smaller document has, as (g, d, first, count).

    The marks that came along are handed on.
    """
    def whole(column, kind):
        return np.concatenate([np.frombuffer(v, kind) for v in group[column]])

    data, n = whole("bytes", np.uint8), whole("n", "<u2").astype(np.int64)
    g, d, first = whole("g", "<i8"), whole("d", "<i8"), whole("first", "<u4").astype(np.int64)
    begin = np.cumsum(n + length - 1) - (n + length - 1)
    run, at, least = first_of_runs(data, begin, n, d, length)
    done = least < d[run]
    at, run = at[done], run[done]
    new, count = runs_of(at, run)
    found = pd.DataFrame({"g": g[run[new]], "d": d[run[new]],
                          "first": first[run[new]] + at[new] - begin[run[new]], "n": count})
    came = [(m["g"], m["d"], m["first"], m["n"]) for marks in group["marks"]
            if marks is not None for m in marks]
    return pd.concat([found, pd.DataFrame(came, columns=found.columns, dtype="int64")])


def spans(first, count, length):
    """Maximal removed spans (begin, end) of windows given as runs."""
    order = np.argsort(first, kind="stable")
    begin = np.asarray(first, np.int64)[order]
    end = np.maximum.accumulate(begin + np.asarray(count, np.int64)[order] + length - 1)
    new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
    last = np.concatenate([new[1:] - 1, [len(begin) - 1]])
    return begin[new], end[last]


def kept_bytes(text, begin, end):
    at, out = 0, []
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return b"".join(out)


def _filter_bits(keys):
    """A filter of fixed size of the keys: words of 64 bits by three hashes of each key."""
    bits = keys.select(F.explode(F.array(*[F.xxhash64("g", F.lit(i)) for i in range(3)])).alias(
        "x")).select(F.pmod("x", F.lit(BITS >> 6)).alias("w"), F.expr(
            "shiftleft(1L, cast(pmod(x >> 40, 64) as int))").alias("b"))
    rows = bits.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    words = np.zeros(BITS >> 6, np.int64)
    words[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64)
    return words


def removals(docs, key="doc_id", text="text", length=LENGTH, part=PART, hot_parts=64):
    """(base, texts, marks) that say which bytes of which document go.

    base: (key, _d, _g, digest, n_bytes, copy, least), a row for each document. texts:
    (_g, _t, _d, hs), the texts with repeated anchors, copies of others left out. marks:
    (g, d, first, n), the runs of windows that a smaller document has, for each such text.
    """
    if not GRAM <= length <= DEPTH:
        raise ValueError(f"length must be from {GRAM} to {DEPTH}")
    spark = docs.sparkSession
    ready(spark)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key), F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("_d"),
                       F.xxhash64(body).alias("_g"), body.alias("_t"))
    base = keep(rows.select(key, "_d", "_g", F.sha2("_t", 256).alias("digest"),
                            F.octet_length("_t").cast("long").alias("n_bytes")), "span-base")
    first = keep(base.groupBy("digest").agg(F.min("_d").alias("least")), "span-first")
    base = base.join(first, "digest").withColumn("copy", F.col("_d") > F.col("least"))
    size = base.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(tasks(spark), size // BUCKET, 1)
    texts = rows.filter(F.octet_length("_t") >= length).select("_g", "_t")

    said = keep(texts.mapInPandas(
        functools.partial(anchor_entries, length, part, buckets), SAID), "span-anchors")
    part_map = said.filter(F.col("bucket") == MAP).select("part", "keys").dropDuplicates(["part"])
    hot_from = max(hot_parts, said.filter(F.col("bucket") == MAP).count() // 10)
    found = keep(said.filter("bucket >= 0").select("bucket", "part", "h", "number", "many")
                 .groupBy("bucket").applyInPandas(
                     functools.partial(repeated_anchors, hot_from),
                     "part long, numbers array<int>, hs array<long>, hot array<boolean>"),
                 "span-repeated")
    release(spark)
    hot = found.select(F.explode(F.arrays_zip("hs", "hot")).alias("x")).filter("x.hot").select(
        "x.hs").distinct().toPandas()["hs"].to_numpy(np.int64).view(np.uint64)
    shared_hot = spark.sparkContext.broadcast(np.sort(hot))
    listed = found.join(part_map, "part").select(
        F.explode(F.arrays_zip("numbers", "hs")).alias("x"), "keys").select(
        F.expr("keys[x.numbers]").alias("g"), F.col("x.hs").alias("h"))
    local = said.filter(F.col("bucket") == LOCAL).select(
        F.explode(F.arrays_zip("keys", "hs")).alias("x")).select(
        F.col("x.keys").alias("g"), F.col("x.hs").alias("h"))
    least = base.groupBy(F.col("_g").alias("g")).agg(F.min("_d").alias("d"))
    flagged = keep(listed.union(local).groupBy("g").agg(F.collect_set("h").alias("hs")).join(
        least, "g"), "span-flagged")
    discard(said)
    discard(found)
    release(spark)
    words = spark.sparkContext.broadcast(_filter_bits(flagged.select("g")))

    @F.pandas_udf("boolean")
    def maybe(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        good = np.ones(len(a), bool)
        for x in (a, b, c):
            x = x.to_numpy(np.int64)
            word = words.value[x % (BITS >> 6)]
            good &= (word.view(np.uint64) >> ((x >> 40) % 64).astype(np.uint64)) & np.uint64(1) > 0
        return pd.Series(good)

    some = rows.filter(F.octet_length("_t") >= length).filter(
        maybe(*[F.xxhash64("_g", F.lit(i)) for i in range(3)]))
    # Bucketed by its text's key, the table meets the marks later without another shuffle.
    some = some.join(flagged, F.col("_g") == F.col("g")).filter(F.col("_d") == F.col("d"))
    some = bucketed(some.select("_g", "_t", "_d", "hs"), "_g", "span_texts")
    discard(flagged)
    release(spark)
    windows = some.mapInPandas(
        functools.partial(contexts, length, part, buckets, shared_hot), WINDOWS)
    marks = windows.groupBy("bucket").applyInPandas(
        functools.partial(covered, length), "g long, d long, first long, n long")
    marks = keep(marks.groupBy("g", "d").agg(F.collect_list("first").alias("first"),
                                             F.collect_list("n").alias("n")), "span-marks")
    return base, some, marks


def _drop(table):
    table.sparkSession.sql(f"DROP TABLE {table.table_name}")


def bucketed(df, column, label):
    """``df`` as a table in the warehouse, bucketed by ``column``."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(tasks(spark), column).option("compression", "zstd").saveAsTable(name)
    made = spark.table(name)
    made.table_name = name
    return made


def remove_repeats(docs, key="doc_id", text="text", length=LENGTH, **sizes):
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of each document."""
    spark = docs.sparkSession
    base, some, marks = removals(docs, key, text, length, **sizes)

    def run(frames):
        for frame in frames:
            out = []
            for g, d, t, first, n in zip(*[frame[c] for c in ("g", "d", "_t", "first", "n")],
                                         strict=True):
                begin, end = spans(first, n, length)
                rest = kept_bytes(bytes(t), begin, end)
                out.append((g, d, len(t) - len(rest), len(begin),
                            hashlib.sha256(rest).hexdigest()))
            yield pd.DataFrame(out, columns=["g", "d", "removed", "spans", "sha"])

    cut = some.select("_g", F.col("_d").alias("d0"), "_t").join(
        marks, F.col("_g") == F.col("g")).filter("d0 = d").select(
        "g", "d", "_t", "first", "n").mapInPandas(
        run, "g long, d long, removed long, spans long, sha string")
    cut = keep(cut.dropDuplicates(["g", "d"]), "span-cut")
    _drop(some)
    release(spark)
    gone = F.col("copy") & (F.col("n_bytes") >= length)
    joined = base.join(cut, (F.col("_g") == F.col("g")) & (F.col("_d") == F.col("d")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        key, "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.when(gone, zero + 1).otherwise(F.coalesce("spans", zero)).alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(
            F.coalesce("sha", "digest")).alias("kept_sha256"))


def cut_documents(docs, key="doc_id", text="text", length=LENGTH, **sizes):
    """The documents without their repeated bytes; those of which nothing is left go.

    All columns stay. A cut may fall inside a character; what is left of it goes too.
    """
    base, some, marks = removals(docs, key, text, length, **sizes)
    _drop(some)
    release(docs.sparkSession)
    gone = base.filter(F.col("copy") & (F.col("n_bytes") >= length)).select(
        F.col("_g").alias("g"), F.col("_d").alias("d"), F.lit(None).cast("array<long>").alias(
            "first"), F.lit(None).cast("array<long>").alias("n")).distinct()
    told = keep(marks.select("g", "d", "first", "n").union(gone), "span-told")
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), F.xxhash64(body).alias("_g"),
                        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("_d"))
    met = whole.join(told, (F.col("_g") == F.col("g")) & (F.col("_d") == F.col("d")), "left")
    met = met.filter(F.col("g").isNull() | F.col("first").isNotNull())

    @F.pandas_udf("string")
    def cut(texts: pd.Series, firsts: pd.Series, counts: pd.Series) -> pd.Series:
        out = []
        for t, first, n in zip(texts, firsts, counts, strict=True):
            if first is not None:
                t = kept_bytes(t.encode("utf-8", "replace"), *spans(first, n, length)).decode(
                    "utf-8", "ignore")
            out.append(t)
        return pd.Series(out, index=texts.index, dtype=object)

    # Else the filter below would have a second call, and each task a second Python worker.
    once = cut.asNondeterministic()
    done = met.withColumn("_left", once(f"_doc.{text}", "first", "n"))
    done = done.filter(F.col("first").isNull() | (F.col("_left") != ""))
    return done.select(*[F.col("_left").alias(text) if c == text else F.col(f"_doc.{c}")
                         for c in docs.columns])
