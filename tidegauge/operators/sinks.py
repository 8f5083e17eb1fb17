"""Alert files, previews and message publishing."""

from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.sources.lines import read_lines


def batch_folder(path, batch_id, stream=None):
    """The folder of a batch: batch numbers are counted anew for each stream."""
    own = f"/query={stream}" if stream else ""
    return f"{path}{own}/batch_id={batch_id}"


def append_alerts(df, path, batch_id, style="csv", stream=None):
    """Write one batch of alert rows below ``path``, in a folder of its own.

    A batch that runs again replaces its own folder, so no alert is there twice. Give the
    ``stream`` if several write below one path. ``style='text'`` writes lines of the form
    ``Sensor(a,b,...)`` instead of CSV, with ``null`` for a null field.
    """
    target = batch_folder(path, batch_id, stream)
    rows = df.select(*schemas.SENSOR.fieldNames())
    if style == "csv":
        rows.write.mode("overwrite").csv(target)
    elif style == "text":
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in rows.columns]
        line = F.concat(F.lit("Sensor("), F.concat_ws(",", *fields), F.lit(")"))
        rows.select(line).write.mode("overwrite").text(target)
    else:
        raise ValueError(f"unknown style {style!r}")


def preview(df, n=20, schema=False):
    """Print the schema if asked for and the first ``n`` rows; returns those rows."""
    if schema:
        df.printSchema()
    head = df.limit(n)
    head.show(n, truncate=False)
    return head


def preview_stream(df, checkpoint, n=10):
    """A stream writer that prints the first ``n`` rows of each batch when started."""
    return (df.writeStream.format("console").option("numRows", n)
            .option("truncate", False).option("checkpointLocation", checkpoint))


def message_rows(lines):
    """Lines as messages with a null key."""
    return lines.select(F.lit(None).cast("binary").alias("key"),
                        F.col("value").cast("string").alias("value"))


def publish_lines(spark, source, target=None, fmt="text", **options):
    """Publish every line of the files at ``source``, written by the executors.

    ``text`` drops them into a landing folder that ``stream_lines`` watches; ``kafka`` sends
    them with a null key to the topic in ``options``.
    """
    publish(read_lines(spark, source), target, fmt, **options)


def publish(lines, target=None, fmt="text", **options):
    if fmt == "text":
        lines.select("value").write.mode("append").text(target)
    else:
        named = {k: str(v) for k, v in options.items()}
        message_rows(lines).write.format(fmt).options(**named).save()


def store_options(store, table, keyspace=None, **extra):
    """Format and options of a connector for a table of an outside store.

    The connectors are packages of their own and are passed through, not part of this library.
    """
    if store == "cassandra":
        if not keyspace:
            raise ValueError("a keyspace is needed")
        fmt, options = "org.apache.spark.sql.cassandra", {"table": table, "keyspace": keyspace}
    elif store == "phoenix":
        fmt, options = "phoenix", {"table": table}
    elif store == "hbase":
        fmt, options = "org.apache.hadoop.hbase.spark", {"hbase.table": table}
    else:
        raise ValueError(f"unknown store {store!r}")
    return fmt, {**options, **{k: str(v) for k, v in extra.items()}}


def write_store(df, store, table, keyspace=None, mode="append", **extra):
    """Rows to a table of an outside store, by its connector."""
    fmt, options = store_options(store, table, keyspace, **extra)
    df.write.format(fmt).options(**options).mode(mode).save()


def read_store(spark, store, table, keyspace=None, **extra):
    """A table of an outside store, by its connector."""
    fmt, options = store_options(store, table, keyspace, **extra)
    return spark.read.format(fmt).options(**options).load()
