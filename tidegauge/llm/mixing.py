"""Mixing sources to target weights by entropy balancing.

Document rates are the exponential tilt ``exp(lambda_source)`` of a base rate of one: of all
rates that meet the token constraint of every source, those closest in relative entropy to
taking each document once. The multipliers are the minimum of the convex dual
``sum(size * exp(lambda)) - sum(lambda * target)``; Newton iterations find it, on token sums
that Spark aggregates. Rates become whole copies: everyone gets the whole part, and the
remaining tokens of a source go, one copy each, to the documents that come first by a hash,
until the source's target is met to within half a document.

Nulls: a null source is a source of its own, after the others; a null text has size 0 and
takes no words. Sources of no words have target 0. Repeated rows are separate documents,
ordered by their size. Empty tables give empty results. Other columns are ignored.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.llm.common import keep, word_count

# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
BINS = 1024


def sized(docs, key="doc_id", source="source", text="text"):
    """(doc_id, source, size, h, bin): h orders the documents of a source."""
    h = F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")), 256)
    return docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"), h.alias("h")).withColumn(
        "bin", F.conv(F.substring("h", 1, 4), 16, 10).cast("int") % BINS)


def targets(sources, share=1.5, cap=2, weights=WEIGHTS):
    """Token targets of (source, source_size), one row for each source.

    The sources share ``share`` times all tokens by weight; none gets more than ``cap`` times
    its own size, and what is cut off is shared by weight among the others. The fixed point
    is found by one sort: sources stop in order of size for their weight.

    The table has a row for each source, not for each document; its windows sort that.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (place % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight.cast("double"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"),
                           F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    stopped = F.coalesce(F.sum("source_size").over(earlier), F.lit(0)) * cap
    left = F.sum("source_size").over(whole) * share - stopped
    weight_left = F.sum("weight").over(whole) - F.coalesce(
        F.sum("weight").over(earlier), F.lit(0.0))
    # Source k stops if its share of what the sources before it leave is above its cap.
    level = ranked.withColumn("level", left / weight_left).withColumn(
        "stops", F.col("level") * F.col("weight") > F.col("source_size") * cap)
    final = F.min(F.when(~F.col("stops"), F.struct(
        F.col("source_size") / F.col("weight"), F.col("level")))).over(whole)["level"]
    return level.select("source", "source_size", "weight", F.when(
        F.col("stops"), F.col("source_size") * F.lit(float(cap))).otherwise(
        final * F.col("weight")).alias("target"))


def solve(moments, tolerance=1e-12, most=200):
    """Multipliers of (source, source_size, target) by Newton iterations on the dual.

    Gradient ``size * exp(lambda) - target`` and Hessian ``size * exp(lambda)`` of every
    source come from the aggregated tokens; the Hessian is diagonal, as every document has
    one source. A step is at most one, which keeps far starts from overshooting. The
    iterations are column expressions over the source table, so they run where its rows are;
    only the largest relative error comes to the driver.
    """
    at = moments.withColumn("lambda", F.lit(0.0))
    has = (F.col("source_size") > 0) & (F.col("target") > 0)
    for _ in range(most // 10):
        for _ in range(10):
            now = F.col("source_size") * F.exp("lambda")
            step = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("target") - now) / now))
            at = at.withColumn("lambda", F.when(has, F.col("lambda") + step).otherwise(
                F.col("lambda")))
        at = keep(at, "mix-dual")
        error = F.abs(F.col("source_size") * F.exp("lambda") / F.col("target") - 1)
        worst = at.agg(F.max(F.when(has, error))).first()[0]
        if worst is None or worst <= tolerance:
            return at
    raise ArithmeticError(f"the dual did not converge: relative error {worst}")


def mix(docs, share=1.5, cap=2, weights=WEIGHTS, key="doc_id", source="source", text="text"):
    """(doc_id, size, source, source_size, target, rate, copies, taken) of each document.

    ``copies`` is whole, at most ``cap``; ``taken`` is copies times size. A source is split
    into bins by hash, so that a source with a third of all rows is summed and ordered in
    many tasks.
    """
    rows = keep(sized(docs, key, source, text), "mix-rows")
    bins = keep(rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")), "mix-bins")
    sums = bins.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    solved = solve(targets(sums, share, cap, weights))
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), F.exp("lambda")))
    solved = solved.withColumn("rate", F.when(F.col("target") > 0, rate).otherwise(F.lit(0.0)))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(
        Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("bin_size").over(before), F.lit(0)))
    bins = bins.join(solved.withColumnRenamed("source", "_s"),
                     F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "lambda", "weight")
    placed = bins.withColumnRenamed("source", "_s").withColumnRenamed("bin", "_b")
    inside = Window.partitionBy("source", "bin").orderBy("h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    joined = rows.withColumn("_ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        placed, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("_b")))
    middle = F.col("before") + F.col("_ahead") + F.col("size") / 2
    whole = F.floor("rate")
    extra = middle <= (F.col("rate") - whole) * F.col("source_size")
    copies = (whole + F.when(extra, 1).otherwise(0)).cast("long")
    return joined.select(
        "doc_id", "size", "source", "source_size", "target", "rate", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"))


def mixed(docs, share=1.5, cap=2, weights=WEIGHTS, key="doc_id", source="source", text="text"):
    """The documents as often as the mix takes them, with all their columns.

    Documents of equal id, source and size are numbered on both sides, so that each finds the
    copies of one of them.
    """
    found = mix(docs, share, cap, weights, key, source, text)

    def numbered(rows, id_, source_, size):
        for name, column in (("_id", id_), ("_source", source_)):
            # Null is a value of its own here: a join on equality would lose it.
            rows = rows.withColumn(name, F.coalesce(
                F.concat(F.lit("="), column.cast("string")), F.lit("")))
        rows = rows.withColumn("_size", size)
        same = ["_id", "_source", "_size"]
        return rows.withColumn("_n", F.row_number().over(
            Window.partitionBy(*same).orderBy("_size"))), [*same, "_n"]

    taken, on = numbered(found.filter("copies > 0"), F.col("doc_id"), F.col("source"), F.col("size"))
    whole, _ = numbered(docs.select(F.struct(*docs.columns).alias("_doc")), F.col(f"_doc.{key}"),
                        F.col(f"_doc.{source}"), word_count(F.col(f"_doc.{text}")))
    again = whole.join(taken.select(*on, "copies"), on).select(
        "_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return again.select("_doc.*")
