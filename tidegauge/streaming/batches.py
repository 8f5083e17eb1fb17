"""Micro-batches: each batch is a DataFrame of its own, handed to one or more sinks.

A batch can run again after a failure, so a sink has to take the same ``batch_id`` twice:
``append_alerts`` replaces that batch's folder, ``upsert`` and ``write_cells`` skip it.
"""

import json

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tidegauge.operators import joins
from tidegauge.sources import files
from tidegauge.sources.clustered import few_keys, only_keys


def stream_id(spark, checkpoint):
    """The id that Spark keeps in a checkpoint: the same after a restart, new in a new one."""
    return json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"]


def placed(batch):
    """The batch with the row's place in its split added to its order of arrival ``seq``."""
    if "seq" not in batch.columns:
        return batch
    return batch.withColumn("seq", F.struct(F.col("seq"), F.monotonically_increasing_id()))


def start_batches(stream, sinks, checkpoint, trigger=None, name=None, mode="append", keep=None):
    """Start a query that calls every ``sink(batch, batch_id)`` on each non-empty batch.

    ``trigger`` is an interval such as ``'2 seconds'``; without one the query takes what is
    there and ends. ``keep`` holds the batch, in memory or on disk, while the sinks run, so
    that it is read and parsed once. It is the default with several sinks, and in update
    and complete mode, where each pass would update the aggregation's state again.
    """
    sinks = list(sinks)
    keep = len(sinks) > 1 or mode != "append" if keep is None else keep

    def each(batch, batch_id):
        if keep:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                for sink in sinks:
                    sink(batch, batch_id)
        finally:
            if keep:
                batch.unpersist()

    writer = (stream.writeStream.foreachBatch(each).outputMode(mode)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=trigger) if trigger else \
        writer.trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def run_batches(stream, sinks, checkpoint, trigger=None, timeout=None, name=None,
                mode="append", keep=None):
    """``start_batches``, wait for the end or ``timeout`` seconds, then stop.

    Returns whether the query ended by itself; a failed batch raises its error.
    """
    query = start_batches(stream, sinks, checkpoint, trigger, name, mode, keep)
    try:
        if timeout is None:
            query.awaitTermination()
            return True
        return query.awaitTermination(timeout)
    finally:
        query.stop()


def batch_sql(view, statement, sink, static=None, on=None, most=joins.KEYS):
    """A sink that registers the batch as ``view``, runs a SQL statement and passes the
    result on. Views registered before can be named as well.

    ``static`` are tables of ``write_clustered``, {name in the statement: table}, that the statement
    joins with the batch by their column ``on``. They are not shuffled for it; beside a batch of at
    most ``most`` keys the statement sees the rows of those keys alone. All views are of the batch's
    session, so views of the caller with these names stay.
    """

    def run(batch, batch_id):
        spark = batch.sparkSession
        batch.createOrReplaceTempView(view)
        if static:
            keys = few_keys(batch, on, most)
            for name, table in static.items():
                only_keys(spark.table(table), on, keys).createOrReplaceTempView(name)
        sink(spark.sql(statement), batch_id)

    return run
