"""Alerts with the pump and the maintenance events of their device.

The device tables are broadcast when a count of their bytes shows that they are small: then
the alerts are not shuffled at all. Otherwise the join shuffles, and keys that would give
one task more than its share are spread over a grid of tasks, see ``spread_join``. A stream
keeps tables beyond that size by device, see ``DeviceTables``.
"""

import contextlib
import functools
import math
import operator

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.session import scratch_dir
from tidegauge.sources import files
from tidegauge.sources.clustered import drop_clustered, few_keys, only_keys, write_clustered

BROADCAST_BYTES = 64 << 20
KEYS = 10_000  # devices of a batch that are looked up by name
ROWS_PER_TASK = 4_000_000  # joined rows
# The columns of the view.
ALERT_COLUMNS = ["date", "psi"]
PUMP_COLUMNS = ["pumpType", "purchaseDate", "serviceDate", "vendor"]
MAINT_COLUMNS = ["eventDate", "technician", "description"]
VIEW = ["resid", *ALERT_COLUMNS, *PUMP_COLUMNS, *MAINT_COLUMNS]


def fits_broadcast(df, limit=BROADCAST_BYTES):
    """Whether the rows of ``df`` take at most ``limit`` bytes, by counting them.

    The optimiser's estimate only spares the count for inputs far beyond the limit.
    """
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(estimate)) > 16 * limit:
        return False
    sized = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema
             if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    row = functools.reduce(operator.add, sized, F.lit(16 + 8 * len(df.columns)))
    counted = df.agg(F.sum(row.cast("bigint")).alias("n")).first()["n"]
    return (counted or 0) <= limit


def alert_maintenance_view(alerts, pump, maint, strategy=None):
    """Inner join of alerts, pump and maint on resid, one row for each pump and event.

    ``strategy`` is what ``join_strategy`` found for the two device tables; a stream finds
    it once and hands it to each batch.
    """
    strategy = strategy or join_strategy(pump, maint)
    narrow = alerts.select("resid", *ALERT_COLUMNS)
    pump, maint = pump.select("resid", *PUMP_COLUMNS), maint.select("resid", *MAINT_COLUMNS)
    if strategy == {"pump": "broadcast", "maint": "broadcast"}:
        return narrow.join(F.broadcast(pump), "resid").join(F.broadcast(maint), "resid").select(
            *VIEW)
    # Each side is counted once; what the first join makes of the alerts follows from that.
    with written(key_counts(narrow, "resid"), "key-counts") as counts, \
            written(key_counts(pump, "resid"), "key-counts") as pumps:
        if strategy["pump"] == "broadcast":
            with_pump = narrow.join(F.broadcast(pump), "resid")
        else:
            with_pump = spread_join(narrow, pump, "resid", left_counts=counts, right_counts=pumps)
        if strategy["maint"] == "broadcast":
            return with_pump.join(F.broadcast(maint), "resid").select(*VIEW)
        counts = counts.join(pumps.withColumnRenamed("n", "m"), "resid").select(
            "resid", (F.col("n") * F.col("m")).alias("n"))
        return spread_join(with_pump, maint, "resid", left_counts=counts).select(*VIEW)


class DeviceTables:
    """Pump and maintenance tables, written once by device for joins with many batches.

    Both are bucketed and sorted by resid, beside a table of how many rows a device has in each. A
    batch of few devices reads only their buckets. A batch of many is shuffled into the same
    buckets, and the tables are not.
    """

    def __init__(self, pump, maint, buckets):
        pump, maint = pump.select("resid", *PUMP_COLUMNS), maint.select("resid", *MAINT_COLUMNS)
        self.spark = pump.sparkSession
        self.names = [write_clustered(df, "resid", buckets) for df in (pump, maint)]
        counts = [key_counts(self.spark.table(n), "resid").withColumnRenamed("n", c)
                  for n, c in zip(self.names, ("pumps", "events"), strict=True)]
        self.names.append(write_clustered(counts[0].join(counts[1], "resid"), "resid", buckets))

    def tables(self, spark):
        """(pump, maint, counts) as tables of a session that shares the catalogue."""
        return [spark.table(n) for n in self.names]

    def view(self, alerts, most=KEYS, limit=BROADCAST_BYTES):
        """The view of a batch of alerts; see ``alert_maintenance_view``."""
        spark = alerts.sparkSession
        pump, maint, counts = self.tables(spark)
        narrow = alerts.select("resid", *ALERT_COLUMNS)
        keys = few_keys(narrow, "resid", most)
        if keys is not None:
            pump, maint = (only_keys(df, "resid", keys) for df in (pump, maint))
            strategy = join_strategy(pump, maint, limit)
            if set(strategy.values()) == {"broadcast"}:
                return alert_maintenance_view(narrow, pump, maint, strategy)
        hot = [k for k, *_ in self._hot(narrow, counts)]
        if not hot:
            return self._joined(narrow, pump, maint)
        some, rest = F.col("resid").isin(hot), ~F.col("resid").isin(hot)
        # The hot devices are few, by the bound of ``hot_keys``, and only their buckets are read.
        return self._joined(narrow.filter(rest), pump, maint).unionByName(alert_maintenance_view(
            narrow.filter(some), pump.filter(some), maint.filter(some),
            {"pump": "spread", "maint": "spread"}))

    def _joined(self, narrow, pump, maint):
        return narrow.join(pump.hint("merge"), "resid").join(
            maint.hint("merge"), "resid").select(*VIEW)

    def _hot(self, narrow, counts):
        made = counts.select("resid", (F.col("pumps") * F.col("events")).alias("n"))
        own = key_counts(narrow, "resid")
        return hot_keys(own, made.join(own.select("resid"), "resid", "left_semi"), "resid")[1]

    def drop(self):
        for name in self.names:
            drop_clustered(self.spark, name)


def join_strategy(pump, maint, limit=BROADCAST_BYTES):
    return {"pump": "broadcast" if fits_broadcast(pump, limit) else "spread",
            "maint": "broadcast" if fits_broadcast(maint, limit) else "spread"}


def key_counts(df, on):
    """Rows of each key, null left out, as (key, n)."""
    return df.filter(F.col(on).isNotNull()).groupBy(on).agg(
        F.count(F.lit(1)).cast("double").alias("n"))


@contextlib.contextmanager
def written(df, label):
    """``df`` as a table in the shared folder, to be read more than once and then removed."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        files.remove_tree(df.sparkSession, path)


def hot_keys(left_counts, right_counts, on, tasks=None):
    """(tasks, keys with more than one task's share of a side's rows or of the joined rows).

    Keys come as rows (key, ls, rs): the key's left rows go to ``ls`` slices, its right rows to
    ``rs``. At most ``3 * tasks`` keys can pass, so the list is small whatever the data. Without
    ``tasks`` there are as many as the joined rows ask for, at least those of a shuffle.
    """
    both = left_counts.withColumnRenamed("n", "nl").join(
        right_counts.withColumnRenamed("n", "nr"), on, "full").fillna(0.0, ["nl", "nr"])
    with written(both, "key-counts") as kept:
        keys = kept.withColumn("nj", F.col("nl") * F.col("nr"))
        sums = keys.agg(*[F.sum(c).alias(c) for c in ("nl", "nr", "nj")]).first()
        if tasks is None:
            least = int(left_counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            most = max(sums[c] or 0 for c in ("nl", "nr", "nj"))
            tasks = max(8, least, math.ceil(most / ROWS_PER_TASK))
        shares = [F.col(c) * F.lit(tasks / (sums[c] or 1.0)) for c in ("nl", "nr", "nj")]
        hot = keys.withColumn("share", F.greatest(*shares)).filter("share > 1").collect()
    found = []
    for row in hot:
        slices = math.ceil(row["share"])
        # The copying cost nr * ls + nl * rs is least when ls / rs is nl / nr.
        best = math.sqrt(slices * row["nl"] / max(row["nr"], 1e-9))
        ls = min(slices, max(1, round(best)))
        found.append((row[on], ls, math.ceil(slices / ls)))
    return tasks, found


def spread_join(left, right, on, tasks=None, left_counts=None, right_counts=None):
    """Inner equi-join that splits hot keys.

    A hot key's left rows are dealt to ``ls`` slices and its right rows to ``rs``; each
    slice is copied to meet every slice of the other side, so each pair of rows meets
    exactly once. Other keys join as usual. The slice of a row depends on its content and
    its input partition only: a task that runs again deals the same way, and even equal
    copies of one row spread. Counts of a side's keys, if known, save counting its rows.
    """
    spark = left.sparkSession
    tasks, hot = hot_keys(key_counts(left, on) if left_counts is None else left_counts,
                          key_counts(right, on) if right_counts is None else right_counts, on, tasks)
    if not hot:
        return left.join(right, on)
    schema = T.StructType([left.schema[on], T.StructField("_ls", T.IntegerType()),
                           T.StructField("_rs", T.IntegerType())])
    grid = F.broadcast(spark.createDataFrame(hot, schema))

    def dealt(df, own, other, own_slice, other_slice):
        deal = F.xxhash64(F.spark_partition_id(), *df.columns)
        own_count = F.coalesce(F.col(own), F.lit(1))
        copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        return (df.withColumn("_deal", deal).join(grid, on, "left")
                .withColumn(own_slice, F.pmod(F.col("_deal"), own_count).cast("int"))
                .withColumn(other_slice, F.explode(copies))
                .drop("_deal", "_ls", "_rs").repartition(tasks, on, "_l", "_r"))

    # A fixed number of tasks: adaptive execution merges tasks by the bytes they read, and
    # slices are small in bytes where it is the joined rows that are many.
    sliced = dealt(left, "_ls", "_rs", "_l", "_r").join(
        dealt(right, "_rs", "_ls", "_r", "_l"), [on, "_l", "_r"])
    return sliced.drop("_l", "_r")
