"""Tables stored by a key: bucketed for joins and groupings, or in ranges for scans.

Joins and groupings by the key do not shuffle a bucketed table. Spark knows the buckets from the
catalogue. A filter on some keys reads only their buckets, and of these only the row groups whose
statistics allow the keys. A table whose session is gone is registered again by ``open_clustered``.

A table in ranges (``write_ranges``) needs no catalogue; a scan of a key prefix or of keys between two
bounds opens the files of the ranges that can hold them.
"""

import uuid

from pyspark.sql import functions as F

from tidegauge.session import scratch_dir
from tidegauge.sources import files

RANGE = "key_range"


def write_clustered(df, key, buckets, name=None, path=None):
    """Write ``df`` and return the name of its table.

    Without a ``path`` the files go to a new folder below the cluster's shared one. Rows are gathered
    by key first, so that a bucket has few files; a key too large for a task is split over several.
    """
    spark = df.sparkSession
    name = name or f"clustered_{uuid.uuid4().hex}"
    (df.hint("rebalance", key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path or scratch_dir(spark, name)).saveAsTable(name))
    return name


def open_clustered(spark, schema, key, buckets, path, name=None):
    """Register the files of ``write_clustered`` at ``path`` under a name; returns the name."""
    name = name or f"clustered_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
              f"SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return name


def drop_clustered(spark, name):
    """Forget the table and remove its files."""
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").collect()
    spark.sql(f"DROP TABLE {name}")
    for row in rows:
        files.remove_tree(spark, row["data_type"])


def write_ranges(df, key, path, ranges, split=()):
    """Write ``df`` below a new ``path`` in so many ranges of a text key, each sorted by it.

    A range has a folder of its own, and a small table has its least and greatest key, read from
    what was written. A key with more rows than a range should hold is split by the columns ``split``
    over several ranges, which then share it. Rows without a key are kept; no scan by key finds them.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(ranges, key, *split).withColumn(RANGE, F.spark_partition_id())
    dealt.sortWithinPartitions(RANGE, key, *split).write.partitionBy(RANGE).parquet(f"{path}/rows")
    written = spark.read.schema(df.select(key).schema.add(RANGE, "integer")).parquet(f"{path}/rows")
    written.groupBy(RANGE).agg(F.min(key).alias("low"), F.max(key).alias("high")).coalesce(1).write.parquet(
        f"{path}/ranges")


def scan_ranges(spark, path, key, schema, prefix=None, low=None, high=None):
    """The rows of ``write_ranges`` whose key starts with ``prefix``, or is at least ``low`` and below ``high``.

    Only folders of ranges that can hold such keys are listed and opened; in their files Parquet's
    statistics leave out row groups. Without a bound all rows are read.
    """
    found = spark.read.schema(f"{RANGE} int, low string, high string").parquet(f"{path}/ranges")
    wanted, rows = F.lit(True), F.lit(True)
    if prefix is not None:
        wanted &= (F.col("high") >= prefix) & ((F.col("low") <= prefix) | F.col("low").startswith(prefix))
        rows &= F.col(key).startswith(prefix)
    if low is not None:
        wanted, rows = wanted & (F.col("high") >= low), rows & (F.col(key) >= low)
    if high is not None:
        wanted, rows = wanted & (F.col("low") < high), rows & (F.col(key) < high)
    folders = [f"{path}/rows/{RANGE}={r[0]}" for r in found.filter(wanted).select(RANGE).collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders).filter(rows)


def few_keys(df, key, most):
    """The distinct keys of ``df``, null left out, if there are at most ``most``, else None."""
    found = df.filter(F.col(key).isNotNull()).select(key).distinct().limit(most + 1).collect()
    return [r[0] for r in found] if len(found) <= most else None


def only_keys(df, key, keys):
    """The rows of those keys; all rows where ``keys`` is None."""
    return df if keys is None else df.filter(F.col(key).isin(keys) if keys else F.lit(False))
