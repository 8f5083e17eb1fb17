"""Document fingerprints: bottom-k sketches of the hashes of five-word shingles.

A sketch is the k smallest distinct shingle hashes, in order, eight bytes each. It is exact
for a text with at most k shingles. Sketches of parts merge into the sketch of the whole, and
two of them estimate resemblance, containment and the number of distinct shingles.

Nulls and empty texts have the empty sketch; two empty sketches resemble each other by 1.
A text of one to four words is one shingle. Word order and words count, white space does not.
Equal texts have equal sketches.

For ``pairs_with_next``: rows are ordered by falling id, null last, and within an id by the
text's checksum; rows equal in both follow each other in any order, as they are the same.
The one row of a one-row table follows itself. An empty table gives an empty result.
"""

import base64
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import keep, ready, tasks
from tidegauge.llm.hashing import shingle_hashes

K = 256
TOP = float(1 << 64)


def bottom(hashes, k=K):
    """The k smallest distinct values, in order."""
    if len(hashes) > 4 * k:
        # Repeats may leave fewer than k distinct among the smallest; then take more.
        take = 2 * k
        while take < len(hashes):
            found = np.unique(np.partition(hashes, take)[:take])
            if len(found) >= k:
                return found[:k]
            take *= 4
    return np.unique(hashes)[:k]


def sketches(texts, k=K):
    hashes, first = shingle_hashes(texts)
    return [bottom(hashes[a:b], k) for a, b in zip(first[:-1], first[1:], strict=True)]


def merge(a, b, k=K):
    """Sketch of the union of the shingle sets of two sketches."""
    return np.unique(np.concatenate([a, b]))[:k]


def distinct(sketch, k=K):
    """Estimated number of distinct shingles; exact below k."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) * TOP / float(sketch[-1])


def resemblance(a, b, k=K):
    """Estimated Jaccard similarity of the shingle sets; exact if their union is below k."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, union, assume_unique=True).sum() / len(union))


def containment(a, b, k=K):
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return min(1.0, shared / distinct(a, k))


def to_text(sketch):
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def from_text(text):
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


@F.pandas_udf(T.StringType())
def fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([to_text(s) for s in sketches(texts)], index=texts.index)


@F.pandas_udf(T.StringType())
def merged(fingerprints: pd.Series) -> str:
    """Aggregate: the fingerprint of all shingles of a group's fingerprints."""
    whole = np.zeros(0, np.uint64)
    for text in fingerprints:
        if text is not None:
            whole = merge(whole, from_text(text))
    return to_text(whole)


LIKENESS = T.StructType([T.StructField(n, T.DoubleType()) for n in
                         ("resemblance", "containment", "distinct", "other_distinct")])


@F.pandas_udf(LIKENESS)
def compared(one: pd.Series, other: pd.Series) -> pd.DataFrame:
    """What two fingerprints say of their texts; containment is of the first in the second."""
    rows = []
    for x, y in zip(one, other, strict=True):
        a, b = from_text(x or ""), from_text(y or "")
        rows.append((resemblance(a, b), containment(a, b), distinct(a), distinct(b)))
    return pd.DataFrame(rows, columns=LIKENESS.names)


def in_blocks(docs, key="doc_id", text="text", blocks=None):
    """(_block, _lead, key, text): documents in blocks of the falling order of their ids.

    ``_lead`` is false but for one added row at the end of each block, the first row of the
    block that follows (of the first block after the last). Rows of a block that fill it are
    equal in number by the quantiles of the ids. Only the first row of each block is added,
    so no more rows than there are blocks.
    """
    spark = docs.sparkSession
    blocks = blocks or 4 * tasks(spark)
    whole = docs.select(F.col(key).cast("long").alias("_k"), F.col(text).alias("_t"),
                        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("_c"))
    cuts = whole.select("_k").agg(F.percentile_approx(
        "_k", [i / blocks for i in range(1, blocks)] or [0.5], 100 * blocks)).first()[0] or []
    cuts = np.array(sorted(set(cuts)), np.int64)

    @F.pandas_udf(T.IntegerType())
    def cuts_above(ids: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, ids.to_numpy(np.int64), "right"))

    # The order falls, and null is in the last block.
    block = F.when(F.col("_k").isNull(), F.lit(len(cuts))).otherwise(
        cuts_above(F.coalesce("_k", F.lit(0))))
    placed = whole.withColumn("_block", block.cast("int"))
    # First of each block: the largest id, then the smallest checksum.
    heads = keep(placed.drop("_t").groupBy("_block").agg(F.min(F.struct(
        F.col("_k").isNull().alias("n"), (-F.col("_k")).alias("k"), F.col("_c").alias("c")
    )).alias("h")), "sketch-heads")
    order = Window.orderBy("_block")  # as many rows as blocks
    after = heads.select(
        F.coalesce(F.lag("_block").over(order), F.max("_block").over(Window.partitionBy())
                   ).alias("_to"), "_block", (-F.col("h.k")).alias("_hk"),
        F.col("h.c").alias("_hc"))
    lead = placed.join(F.broadcast(after), "_block").filter(
        F.col("_k").eqNullSafe(F.col("_hk")) & (F.col("_c") == F.col("_hc")))
    lead = lead.dropDuplicates(["_to"]).select(
        F.col("_to").alias("_block"), F.lit(True).alias("_lead"), "_k", "_t", "_c")
    return placed.select("_block", F.lit(False).alias("_lead"), "_k", "_t", "_c").union(lead)


def pairs_with_next(docs, key="doc_id", text="text"):
    """Each document, its edited text and the likeness of its fingerprint to two others.

    The edited text has its last third of code points replaced by the first as many of the
    next document. A task holds one Arrow batch of texts and the row before it.
    """
    ready(docs.sparkSession)
    rows = in_blocks(docs, key, text)
    n = tasks(docs.sparkSession)
    ordered = rows.repartition(n, "_block").sortWithinPartitions(
        F.col("_block"), F.col("_lead"), F.col("_k").desc_nulls_last(), F.col("_c"))

    def run(frames):
        held = None
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at:at + 256]
                held, out = _edited(held, part)
                if len(out):
                    yield out

    return ordered.select("_block", "_lead", "_k", "_t").mapInPandas(run, (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, "
        "n_shingles double"))


def _edited(held, part):
    """Rows for ``held`` and all but the last row of ``part``, which is held next."""
    keys = list(part["_k"])
    texts = [t if isinstance(t, str) else "" for t in part["_t"]]
    leads, blocks = list(part["_lead"]), list(part["_block"])
    if held:
        keys, texts = [held[0], *keys], [held[1], *texts]
        leads, blocks = [held[2], *leads], [held[3], *blocks]
    own, edits = [], []
    for i in range(len(texts) - 1):
        if leads[i]:
            continue
        text = texts[i]
        cut = len(text) // 3
        own.append(i)
        edits.append(text[:len(text) - cut] + texts[i + 1][:cut])
    marks = sketches(texts)
    changed = sketches(edits)
    out = [(keys[i], len(texts[i]), hashlib.sha256(edit.encode("utf-8", "replace")).hexdigest(),
            to_text(marks[i]), to_text(new), resemblance(marks[i], new),
            resemblance(marks[i], marks[i + 1]), distinct(marks[i]))
           for i, edit, new in zip(own, edits, changed, strict=True)]
    frame = pd.DataFrame(out, columns=[
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        "near_edited", "near_next", "n_shingles"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    return (keys[-1], texts[-1], leads[-1], blocks[-1]), frame
