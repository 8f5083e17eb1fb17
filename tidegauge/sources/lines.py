"""Text lines from files, landing folders, message topics and sockets."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark, path):
    """Every line of the text files below ``path`` as column ``value``."""
    return spark.read.text(path)


def widen(df):
    """Deal the rows of an input that cannot be split over all cores.

    A single compressed file or row group would otherwise keep one core busy with all the
    work after it. Inputs of two splits or more are never shuffled for it: lower
    ``spark.sql.files.maxPartitionBytes`` to split them further.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if splits == 1 < cores else df


def kafka_options(servers, topics, group=None, threads=None, **extra):
    """Reader options for a comma-separated topic list.

    ``threads`` is the number of readers wished for each topic.
    """
    names = [t.strip() for t in topics.split(",") if t.strip()]
    if not names:
        raise ValueError("no topic given")
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(names)}
    if group:
        options["kafka.group.id"] = group
    if threads:
        options["minPartitions"] = str(threads * len(names))
    options.update({k: str(v) for k, v in extra.items()})
    return options


def arrival_order(df, fmt):
    """A column that orders messages by arrival, or None if the source has none.

    Files: modification time, path and start of the split. Topics: timestamp, partition and
    offset. ``streaming.placed`` adds a row's place within its split.
    """
    if {"timestamp", "partition", "offset"} <= set(df.columns):
        return F.struct("timestamp", "partition", "offset")
    if fmt in ("text", "parquet"):
        return F.struct("_metadata.file_modification_time", "_metadata.file_path",
                        "_metadata.file_block_start")
    return None


def message_identity(df, fmt):
    """What a message is known by, or None if the source tells no two messages apart.

    Topics: topic, partition and offset. Files of rows: the file's name, without its folder, and the
    row's place in it, so a file that is delivered again into another folder holds the same messages.
    """
    if {"topic", "partition", "offset"} <= set(df.columns):
        return F.struct("topic", "partition", "offset")
    if fmt == "parquet":
        return F.struct("_metadata.file_name", "_metadata.row_index")
    return None


def message_text(df, body="value", seq=None, extra=()):
    """The message body as text column ``value``, whatever its stored type, and its order."""
    column = F.col(body)
    if isinstance(df.schema[body].dataType, T.BinaryType):
        column = F.decode(column, "UTF-8")
    order = [] if seq is None else [seq.alias("seq")]
    return df.select(column.cast("string").alias("value"), *order, *extra)


def stream_lines(spark, path=None, fmt="text", body="value", schema=None, once=None, **options):
    """A stream of lines, with ``seq``, the order of their arrival, where the source has one.

    ``text`` watches a landing folder: each new file's lines become rows. Other formats
    (``kafka``, ``parquet``, ``socket`` or any installed one) pass ``options`` through and give the
    text of the ``body`` column, binary bodies decoded.

    ``once``, a time such as ``'1 hour'``, drops a message that is delivered again within that time,
    by its identity; a source without one is an error. Its state are the identities of that time.
    Messages that are themselves later than that by their time are left out.
    """
    reader = spark.readStream.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        reader = reader.schema(schema)
    loaded = reader.load(path) if path else reader.load()
    if once is None:
        return message_text(loaded, body, arrival_order(loaded, fmt))
    identity = message_identity(loaded, fmt)
    if identity is None:
        raise ValueError(f"messages of {fmt} have no identity")
    at = F.col("timestamp") if fmt == "kafka" else F.col("_metadata.file_modification_time")
    order = arrival_order(loaded, fmt)
    known = message_text(loaded, body, order, [identity.alias("_id"), at.alias("_at")])
    return known.withWatermark("_at", once).dropDuplicatesWithinWatermark(["_id"]).drop("_id", "_at")
