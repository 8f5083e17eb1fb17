"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles: term frequency times inverse document
frequency. Improved consistent weighted sampling draws samples that agree between two
documents with the probability of their weighted Jaccard similarity. Samples form bands;
documents that agree in a band meet in a bucket. In each bucket all members are compared with
leaders, and pairs of a weighted Jaccard similarity of at least ``least`` are links. Classes are
the connected components of links and exact copies.

Document frequencies are exact, of every shingle, and count over all documents. A shingle weighs
1 + log(1 + log(documents / documents that have it)): it falls with each further document, and has no ceiling. The
second logarithm is on purpose: with one only, the shingles of a text of which a third of all documents are edited
copies weigh so little against those of the edits that no copy is similar to another. Documents are dealt to
chunks of some ``CHUNK`` bytes; a chunk sends each of its distinct shingles once, by ranges of the hash, and gets the
sums over all chunks back in the same order (``sent``, ``returned``). A text then carries the frequencies of its shingles.

A bucket is led by its ``LEADERS`` most popular members, those in the largest buckets; all its
members are compared with each of them. So buckets of up to ``LEADERS + 1`` members are compared
completely, and a bucket of n members costs ``LEADERS`` * n comparisons, never all pairs. The members
of larger buckets that are then still of several classes go through an exact join: the first
shingles of a text, rarest first, up to where the rest weighs too little for a link, meet those of other
classes, and every pair that their weights do not rule out is compared unless other links have
joined it meanwhile. No bucket is capped and no pair that meets in one is left out. As with any banding a
pair may meet in no band: one at 0.8 with a chance of 1 in 600.

Nulls count as empty texts. Texts without words are linked to exact copies only; one to four
words are one shingle. Rows of one id are one document: each of their texts is compared, and their classes
join. A null id, and that of an id's second and later texts, is replaced by a number from the hash of the text,
above those of real ids. An empty table gives an empty result.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import discard, keep, ready, release, smaller_batches, tasks, utf8_bytes
from tidegauge.llm.components import components, moved
from tidegauge.llm.hashing import mix, shingle_hashes

BANDS, ROWS = 9, 3
RARE = float("inf")  # frequent_shingles lists those in at least 1/RARE of all documents: all
CHUNK = 2 << 20  # bytes of texts whose shingles are sent together
RANGE = 16 << 20  # bytes of texts, in all, for each range of hashes
BATCH_BYTES = 2 << 20  # of Arrow batches
LEADERS = 3  # members of a bucket that all others are compared with
STEP = float(np.log(1.02))  # texts of the exact join meet by the logarithm of their weight
SLACK = 1e-6  # what rounding may add to a bound
FIRST, MORE = 1, 16  # pairs of two classes and a share that are tried at once, and how they grow
SHARES = 8
BEFORE = 8  # shingles before its own that a row of the exact join carries
GROUP = 64  # members compared with one copy of their leader

_rng = np.random.default_rng(20240229)  # a fixed seed: every worker draws the same tables
_R = _rng.gamma(2.0, 1.0, 1 << 14).astype(np.float32) + np.float32(1e-4)
_LOG_C = np.log(np.sort(_rng.gamma(2.0, 1.0, 1 << 18)) + 1e-12).astype(np.float32)


def counted(texts):
    """(shingle hashes, times, offsets) of the texts, shingles of a text distinct and sorted."""
    hashes, first = shingle_hashes(texts)
    parts, counts = [], []
    for a, b in zip(first[:-1], first[1:], strict=True):
        values, n = np.unique(hashes[a:b], return_counts=True)
        parts.append(values)
        counts.append(n)
    offset = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offset[1:])
    if not offset[-1]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), offset
    return np.concatenate(parts), np.concatenate(counts), offset


def weights_of(times, df, n_docs):
    """Term frequency times inverse document frequency."""
    return times * (1 + np.log1p(np.log(n_docs / df)))


def weighted(texts, frequent, n_docs):
    """(shingle hashes, weights, offsets) of the texts, shingles of a text distinct and sorted.

    ``frequent`` is (sorted hashes, document frequencies); a shingle not among them is in one document.
    """
    values, times, offset = counted(texts)
    keys, known = frequent
    df = np.ones(len(values))
    if len(keys):
        at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        hit = keys[at] == values
        df[hit] = known[at[hit]]
    return values, weights_of(times, df, n_docs), offset


def reweighted(texts, carried, n_docs):
    """The same, of texts that carry the document frequencies of their shingles, as ``banded`` gives them."""
    values, times, offset = counted(texts)
    return values, weights_of(times, np.frombuffer(b"".join(carried), np.int64), n_docs), offset


def samples(values, weights, offset, seeds):
    """One consistent weighted sample of each text for each seed, as 64-bit numbers.

    Texts must have a shingle each. The random numbers of a shingle come from its hash and the
    seed alone, through tables of draws from Gamma(2, 1).
    """
    log_w = np.log(weights).astype(np.float32)
    starts, sizes = offset[:-1], np.diff(offset)
    found = np.empty((len(starts), len(seeds)), np.uint64)
    for j, seed in enumerate(seeds):
        x = mix(values ^ seed)
        r = _R[(x & np.uint64(0x3FFF)).astype(np.int64)]
        beta = ((x >> np.uint64(14)) & np.uint64(0xFFFF)).astype(np.float32) / np.float32(65536)
        log_c = _LOG_C[(x >> np.uint64(46)).astype(np.int64)]
        t = np.floor(log_w / r + beta)
        log_a = log_c - r * (t - beta) - r
        least = np.minimum.reduceat(log_a, starts)
        at = np.flatnonzero(log_a == np.repeat(least, sizes))
        # The first of equal minima: shingles are in order of their hash.
        at = at[np.searchsorted(at, starts)]
        found[:, j] = mix(values[at] ^ mix(t[at].astype(np.int64).astype(np.uint64) + seed))
    return found


def bands(values, weights, offset, turn=0, n_bands=BANDS, rows=ROWS):
    """Band keys, one row of ``n_bands`` for each text; ``turn`` gives fresh samples."""
    start = 1 + turn * n_bands * rows
    seeds = mix(np.arange(start, start + n_bands * rows, dtype=np.uint64))
    drawn = samples(values, weights, offset, seeds)
    keys = np.zeros((len(drawn), n_bands), np.uint64)
    for b in range(n_bands):
        for k in range(rows):
            keys[:, b] = mix(keys[:, b] ^ drawn[:, b * rows + k])
        keys[:, b] = mix(keys[:, b] + np.uint64(b + 1))
    return keys.view(np.int64)


def similarity(one, other):
    """Weighted Jaccard similarity of two (hashes, weights)."""
    (ha, wa), (hb, wb) = one, other
    both, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    shared = np.minimum(wa[ia], wb[ib]).sum()
    total = wa.sum() + wb.sum() - shared
    return float(shared / total) if total else 0.0


def made_id(body):
    """A number above real ids, from the text."""
    return F.xxhash64(body).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)


def node_of(key, body):
    """The id of a document; for a null id a number above real ids, from the text."""
    return F.coalesce(key.cast("long"), made_id(body))


def small_parts(frame, rows=128, chars=200_000):
    """Parts of a frame of so many rows and about so many characters of text; one row at least."""
    column = "t" if "t" in frame.columns else "_t"
    ends = frame[column].str.len().fillna(0).cumsum().to_numpy()
    at = 0
    while at < len(frame):
        done = ends[at - 1] if at else 0
        to = max(at + 1, min(at + rows, int(np.searchsorted(ends, done + chars, "right"))))
        yield frame.iloc[at:to]
        at = to


def dealt(rows, size):
    """(chunk, _n, _t) of rows (_n, _t) whose texts have ``size`` bytes in all.

    Equal rows of one partition share a chunk, those of others need not: a group of copies without an id is spread.
    """
    chunk = F.pmod(F.xxhash64("_n", F.spark_partition_id()), F.lit(size // CHUNK + 1))
    return rows.select(chunk.alias("chunk"), "_n", "_t")


def planes(numbers):
    """The numbers' first bytes, then their second ones and so on: bytes that are all zero take no room in a shuffle."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def unplaned(data, kind):
    return np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def in_parts(texts):
    """``counted``, some texts at a time."""
    found = [counted(part["_t"]) for part in small_parts(pd.DataFrame({"_t": texts}))]
    values, times, offsets = zip(*found, strict=True)
    ends = np.cumsum(np.concatenate([np.diff(o) for o in offsets]))
    return np.concatenate(values), np.concatenate(times), np.concatenate([[0], ends])


def sent(chunks, ranges):
    """(chunk, part, hashes, docs): a chunk's distinct shingles in order and in how many of its texts each is.

    Of each hash the difference to the one before is sent, which is a smaller number.
    ``part`` is the number of a range of hashes; no chunk has more than one row for it.
    """

    def run(frame):
        values, docs = np.unique(in_parts(frame["_t"])[0], return_counts=True)
        part = ((values >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        own, first = np.unique(part, return_index=True)
        ends = np.append(first, len(part))[1:]
        return pd.DataFrame({
            "chunk": np.full(len(own), frame["chunk"].iat[0]), "part": own,
            "hashes": [planes(np.diff(values[a:b], prepend=np.uint64(0))) for a, b in zip(first, ends, strict=True)],
            "docs": [planes(docs[a:b].astype(np.int32)) for a, b in zip(first, ends, strict=True)]})

    return chunks.groupBy("chunk").applyInPandas(run, "chunk long, part long, hashes binary, docs binary")


def summed(frame):
    """(hashes, documents, place of each sent hash among them) of the rows of one part of ``sent``."""
    every = np.concatenate([np.cumsum(unplaned(x, np.uint64), dtype=np.uint64) for x in frame["hashes"]])
    hashes, at = np.unique(every, return_inverse=True)
    docs = np.concatenate([unplaned(x, np.int32) for x in frame["docs"]])
    return hashes, np.bincount(at, docs, len(hashes)).astype(np.int64), at


def returned(rows):
    """(chunk, part, df): the document frequencies of what was sent, in its order."""

    def run(frame):
        _, docs, at = summed(frame)
        ends = np.cumsum(frame["docs"].str.len().to_numpy() // 4)
        df = [planes(x) for x in np.split(docs[at], ends[:-1])]
        return pd.DataFrame({"chunk": frame["chunk"], "part": frame["part"], "df": df})

    return rows.groupBy("part").applyInPandas(run, "chunk long, part long, df binary")


def ranges_of(spark, size):
    return max(tasks(spark), -(-size // RANGE))


def frequent_shingles(docs, text="text", rare=RARE):
    """Sorted hashes and exact document frequencies of shingles in at least n/rare documents, and n.

    The list comes to the driver. The operator does not use it: its frequencies stay with the texts.
    """
    ready(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(body)), F.lit(0))).first()
    rows = docs.select(made_id(body).alias("_n"), body.alias("_t"))

    def run(frame):
        hashes, docs, _ = summed(frame)
        return pd.DataFrame({"h": hashes.view(np.int64), "df": docs})

    found = sent(dealt(rows, size), ranges_of(docs.sparkSession, size)).groupBy("part").applyInPandas(
        run, "h long, df long").filter(F.col("df") >= n / rare).collect()
    keys = np.array([r["h"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return (keys[order], np.array([r["df"] for r in found], float)[order]), n


def banded(chunks, n_docs, ranges, turn=0):
    """(_n, keys, _d) of each row of ``dealt``: its band keys, null without a word, and the document
    frequencies of its distinct shingles in order, as 64-bit numbers.
    """

    def run(frame, back):
        values, times, offset = in_parts(frame["_t"])
        known = np.unique(values)
        df = np.concatenate([np.zeros(0, np.int64), *(
            unplaned(x, np.int64) for x in back.sort_values("part")["df"])])
        if len(df) != len(known):
            raise RuntimeError("a chunk's rows changed while their shingles were counted")
        df = df[np.searchsorted(known, values)]
        full = np.flatnonzero(np.diff(offset))
        keys = [None] * len(frame)
        if len(full):
            kept = np.concatenate([offset[:-1][full], offset[-1:]])
            for k, own in zip(full, bands(values, weights_of(times, df, n_docs), kept, turn), strict=True):
                keys[k] = own
        return pd.DataFrame({"_n": frame["_n"], "keys": keys, "_d": [
            df[a:b].tobytes() for a, b in zip(offset[:-1], offset[1:], strict=True)]})

    back = returned(sent(chunks, ranges))
    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(
        run, "_n long, keys array<long>, _d binary")


def leaders(members):
    """(bucket, leader, size), up to ``LEADERS`` for each bucket of two or more.

    A member is the more popular, the larger the buckets that it is in. Of a group of edited
    copies the text they were made from agrees with most of them in most bands, so it leads
    nearly every bucket of the group.
    """
    sizes = keep(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter(
        "size > 1"), "near-sizes", True)
    sized = keep(members.join(sizes, "bucket"), "near-sized", True)
    popular = keep(sized.groupBy("node").agg(F.sum(F.col("size").cast("double")).alias("weight")),
                   "near-popular", True)
    order = Window.partitionBy("bucket").orderBy(F.col("weight").desc(), "node")
    heads = sized.join(popular, "node").withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= LEADERS)
    return keep(heads.select("bucket", F.col("node").alias("leader"), "size"), "near-heads", True)


def verified(pairs, texts, n_docs, least):
    """The pairs (leader, node) whose texts have at least that similarity.

    Members are dealt to groups of some ``GROUP``, each with a copy of its leader's text. A task
    reads the groups in order and holds the leader's shingles and one batch of members.
    """
    spark = pairs.sparkSession
    counted = keep(pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("n")), "near-sizes", True)
    groups = F.ceil(F.col("n") / GROUP)
    dealt = pairs.join(counted, "leader").select(
        "leader", "node", F.pmod(F.xxhash64("node"), groups).cast("int").alias("part"))
    own = counted.select("leader", F.col("leader").alias("node"),
                         F.explode(F.sequence(F.lit(0), (groups - 1).cast("int"))).alias("part"))
    placed = dealt.union(own).join(texts.withColumnRenamed("_n", "node"), "node")
    ordered = placed.repartition(tasks(spark), "leader", "part").sortWithinPartitions(
        "leader", "part", (F.col("node") != F.col("leader")))

    def run(frames):
        held = (None, None)
        for frame in frames:
            for rows in small_parts(frame):
                values, weights, offset = reweighted(rows["_t"], rows["_d"], n_docs)
                out = []
                for k, (leader, node) in enumerate(zip(rows["leader"], rows["node"], strict=True)):
                    own = slice(offset[k], offset[k + 1])
                    mine = values[own], weights[own]
                    if node == leader:
                        held = (leader, mine)
                    elif held[0] == leader and similarity(held[1], mine) >= least:
                        out.append((leader, node))
                if out:
                    yield pd.DataFrame(out, columns=["a", "b"])

    return ordered.select("leader", "node", "_t", "_d").mapInPandas(run, "a long, b long")


def level(weight):
    return F.floor(F.log(weight) / STEP)


def candidates(crowd, texts, n_docs, least):
    """(leader, node, hope): pairs of crowd members (node, class) of two classes that may be links.

    Shingles are in one order, by the number of members that have them. All that a pair shares stands
    from its first shared shingle on, so both texts' weight from there on must be enough for the sum of both
    weights: only shingles before the rest is below ``least`` of a text count, and the heavier text
    is looked for among weights that its rest allows. Members of a shingle's largest class meet only
    those of others. ``hope`` is the largest such rest of both.

    A pair may share hundreds of such shingles and need meet at the first only. Each row carries the
    ``BEFORE`` shingles before its own; where the two texts share one of these, they have met there.
    """

    def run(frames):
        for frame in frames:
            for part in small_parts(frame):
                values, weights, offset = reweighted(part["_t"], part["_d"], n_docs)
                sizes = np.diff(offset)
                total = np.array([weights[x:y].sum() for x, y in zip(offset[:-1], offset[1:], strict=True)])
                yield pd.DataFrame({
                    "h": values.view(np.int64), "node": np.repeat(part["node"].to_numpy(), sizes),
                    "class": np.repeat(part["class"].to_numpy(), sizes), "w": weights,
                    "total": np.repeat(total, sizes)})

    own = crowd.join(texts.withColumnRenamed("_n", "node"), "node").select("node", "class", "_t", "_d")
    found = keep(own.mapInPandas(run, "h long, node long, class long, w double, total double"), "near-shingles")
    counted = found.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("class").alias("low"),
                                     F.max("class").alias("high")).filter("df > 1")
    order = Window.partitionBy("node").orderBy("df", "h")
    ordered = found.join(counted, "h", "left").withColumn("df", F.coalesce("df", F.lit(1))).withColumn(
        "rest", F.col("total") - F.sum("w").over(order) + F.col("w")).withColumn(
        "before", F.collect_list("h").over(order.rowsBetween(-BEFORE, -1)))
    first = keep(ordered.filter((F.col("rest") >= F.col("total") * (least * (1 - SLACK))) & (
        F.col("low") < F.col("high"))).select("h", "node", "class", "total", "rest", "before"), "near-first-shingles")
    discard(found)
    largest = first.groupBy("h", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("h").agg(
        F.max_by("class", F.struct("n", "class")).alias("main"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    most = F.col("rest") * ((1 + least) / least) - F.col("total")  # weight of the other text
    near = keep(first.join(largest.drop("n"), "h").withColumn("most", most * (1 + SLACK)), "near-meeting")
    light = near.filter("most >= total").withColumn("level", level("total"))
    heavy = near.withColumn("level", F.explode(F.sequence(
        level(F.col("total") * (least * (1 - 4 * SLACK))), level(F.least("total", "most")))))

    def meeting(one, other):
        s, l = one.alias("s"), other.alias("l")
        shared_most = F.least("s.rest", "l.rest") * (1 + SLACK)
        return s.join(l, ["h", "level"]).filter(
            (F.col("s.class") != F.col("l.class"))
            & (F.struct("s.total", "s.node") < F.struct("l.total", "l.node"))
            & ~F.arrays_overlap("s.before", "l.before")
            & (shared_most >= (F.col("s.total") + F.col("l.total")) * (least / (1 + least)))).select(
            F.col("s.node").alias("leader"), F.col("l.node").alias("node"),
            (F.col("s.rest") + F.col("l.rest")).alias("hope"))

    aside = F.col("class") != F.col("main")
    met = meeting(light.filter(aside), heavy).union(meeting(light.filter(~aside), heavy.filter(aside)))
    return met.groupBy("leader", "node").agg(F.max("hope").alias("hope"))


def settled(now, crowd, texts, n_docs, least):
    """The classes when every link between members of the crowd counts.

    The most hopeful pairs of two classes are compared first; pairs that their links join need no more
    comparison. The rest follows until none is left. Only the new links and the classes they join are
    looked at again, not all links.
    """
    left = keep(candidates(crowd, texts, n_docs, least), "near-candidates")
    first = FIRST
    while True:
        one, other = (now.select(F.col("node").alias(c), F.col("class").alias(f"{c}_class"))
                      for c in ("leader", "node"))
        apart = left.select("leader", "node", "hope").join(one, "leader", "left").join(other, "node", "left").select(
            "leader", "node", "hope", F.coalesce("leader_class", "leader").alias("x"),
            F.coalesce("node_class", "node").alias("y")).filter("x != y")
        order = Window.partitionBy(F.least("x", "y"), F.greatest("x", "y"), F.pmod(
            F.xxhash64("leader", "node"), F.lit(SHARES))).orderBy(F.col("hope").desc(), "leader", "node")
        left = keep(apart.withColumn("rank", F.row_number().over(order)), "near-candidates", True)
        tried = left.filter(F.col("rank") <= first)
        if not tried.limit(1).count():
            return now
        found = keep(verified(tried.select("leader", "node"), texts, n_docs, least), "near-links").select(
            F.col("a").alias("leader"), F.col("b").alias("node"))
        if found.limit(1).count():
            joined = keep(components(tried.join(found, ["leader", "node"]).select("x", "y"), "x", "y"),
                          "near-joined", True)
            alone = joined.join(now.select("node"), "node", "left_anti")  # classes of one that had no link
            now = keep(moved(now, joined).union(alone), "near-now", True)
        left = left.filter(F.col("rank") > first)
        first *= MORE


def classes(docs, key="doc_id", text="text", least=0.8):
    """(id, class_id) of each row: class_id is the smallest id of the class."""
    # The texts compared are shuffled while an executor still has what the stages before needed.
    with smaller_batches(docs.sparkSession, BATCH_BYTES):
        return _classes(docs, key, text, least)


def _classes(docs, key, text, least):
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(node_of(F.col(key), body).alias("_n"),
                       body.alias("_t"), F.col(key).isNull().alias("_null"))
    digest = F.sha2("_t", 256)
    digests = keep(rows.select("_n", "_null", digest.alias("digest"), made_id("_t").alias("made"),
                               utf8_bytes("_t").alias("size")), "near-digests", True)
    n_docs, size = digests.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    # Ids of several texts: the text of the least digest has the id, the others a number of their own.
    several = keep(digests.groupBy("_n").agg(F.min("digest").alias("own"), F.max("digest").alias("last")).filter(
        "own < last").drop("last"), "near-several", True)
    numbered = digests.withColumn("_m", F.col("_n"))
    if several.limit(1).count():
        def number(made, of):
            return F.when(F.col("own") != of, made).otherwise(F.col("_n"))

        numbered = digests.join(several, "_n", "left").withColumn("_m", number(F.col("made"), F.col("digest")))
        rows = keep(rows.join(several, "_n", "left").select(
            number(made_id("_t"), digest).alias("_n"), "_t"), "near-numbered")
    first = keep(numbered.groupBy("digest").agg(F.min("_m").alias("node")), "near-first", True)
    copies = keep(numbered.join(first, "digest").select("_n", "_null", "_m", "node"), "near-copies", True)
    nodes = copies.select("node").distinct()
    banded_rows = keep(banded(dealt(rows, size), n_docs, ranges_of(spark, size)), "near-bands")
    release(spark)
    keyed = banded_rows.join(nodes.withColumnRenamed("node", "_n"), "_n", "left_semi")
    members = keep(keyed.select(F.explode("keys").alias("bucket"), F.col("_n").alias("node"))
                   .distinct(), "near-buckets", True)
    pairs = [copies.filter(F.col(b) != F.col(a)).select(F.col(a).alias("a"), F.col(b).alias("b"))
             for a, b in (("node", "_m"), ("_n", "_m"))]  # copies of a text, texts of an id
    linked = keep(pairs[0].union(pairs[1]).distinct(), "near-linked", True)
    heads = leaders(members)
    pairs = keep(members.join(heads, "bucket").filter(F.col("node") != F.col("leader")).select(
        "leader", "node").distinct(), "near-pairs", True)
    if pairs.limit(1).count():
        wanted = pairs.select(F.col("leader").alias("_n")).union(pairs.select("node")).distinct()
        # Whatever their number: a plan that changes with it would not show its cost.
        texts = keep(rows.select("_n", "_t").join(wanted.hint("merge"), "_n").dropDuplicates(["_n"]).join(
            banded_rows.select("_n", "_d").hint("merge"), "_n").dropDuplicates(["_n"]), "near-texts")
        discard(banded_rows)
        # Texts are compared by all tasks; only the table of links is narrow.
        linked = keep(linked.union(keep(verified(pairs, texts, n_docs, least), "near-links")),
                      "near-linked", True)
        now = keep(components(linked), "near-now", True)
        # Larger buckets with several classes: their members' other pairs are still to be compared.
        seen = members.join(heads.filter(F.col("size") > LEADERS + 1).select("bucket").distinct(),
                            "bucket", "left_semi").join(now, "node", "left").select(
            "bucket", "node", F.coalesce("class", "node").alias("class"))
        split = seen.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter(
            "low < high")
        crowd = keep(seen.join(split.select("bucket"), "bucket", "left_semi").select(
            "node", "class").distinct(), "near-crowd", True)
        if crowd.limit(1).count():
            now = settled(now, crowd, texts, n_docs, least)
        discard(texts)
    else:
        now = components(linked)
    now = now.withColumnRenamed("node", "_n")
    return copies.join(now, "_n", "left").select(
        F.when(~F.col("_null"), F.col("_n")).alias(key),
        F.coalesce("class", "node").alias("class_id"))


def keep_one(docs, key="doc_id", text="text", least=0.8):
    """The documents that are the smallest id of their class, one row each, with all columns.

    Of rows with one id, or of equal texts without an id, one stays: that of the text with the least digest,
    and of those one whose columns' hash is least.
    """
    found = keep(classes(docs, key, text, least).distinct(), "near-classes")
    node = node_of(F.col(key), F.coalesce(F.col(text), F.lit("")))
    stay = found.select("class_id").distinct()
    rows = docs.withColumn("_node", node).join(
        stay.withColumnRenamed("class_id", "_node"), "_node", "left_semi")
    order = F.struct(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), F.xxhash64(*[
        f.name for f in docs.schema if isinstance(f.dataType, T.AtomicType)]))
    return rows.groupBy("_node").agg(F.min_by(F.struct(*docs.columns), order).alias("_row")).select("_row.*")
