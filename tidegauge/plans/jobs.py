"""The jobs as a user runs them: a source, an operator chain and a sink each.

Batch jobs take paths. Stream jobs take a stream, of lines from ``stream_lines`` or of rows
parsed from it, a target and a checkpoint folder; ``timeout`` and ``name`` go to
``run_batches``. ``trigger`` is how often they take a batch; ``trigger=None`` takes what is there
and ends. Writes to one key go by the order of arrival, the stream's ``seq``; batches are
told apart by the id in the checkpoint, so several streams may share a target, one after the other.
``buckets`` is the number of folders of a keyed table: choose it so that one holds some gigabytes.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import schemas
from tidegauge.operators import cells, joins, keyed_table, sinks, stats
from tidegauge.operators.filters import alerts, keyword_filter
from tidegauge.operators.parse import (BAD, good_rows, parse_employee, parse_vmstat,
                                       project_posts)
from tidegauge.sources import read_employees, read_lines
from tidegauge.streaming import arrival_windows, placed, run_batches, stream_id

# How often each stream job takes a batch.
STATS_INTERVAL = "2 seconds"
ALERT_INTERVAL = "5 seconds"
CELL_INTERVAL = "10 seconds"
WITHOUT_LAST_NAME = ["emp_no", "birth_date", "first_name", "gender", "hire_date"]


# Batch --------------------------------------------------------------------------------

def employees_to_table(spark, source, fmt, table, buckets, null_key="reject", seq=None):
    """Upsert employee files into the table; Avro leaves last_name as it is stored.

    Returns the rows without a number, which are not written.
    """
    keyed_table.ensure_table(spark, table, schemas.EMPLOYEE, ["emp_no"], buckets)
    rows = read_employees(spark, source, fmt, null_key)
    bad = None
    if BAD in rows.columns:
        bad, rows = rows.filter(F.col(BAD).isNotNull()).select(BAD), good_rows(rows)
    columns = WITHOUT_LAST_NAME if fmt == "avro" else None
    keyed_table.upsert(spark, table, rows, seq=seq, columns=columns)
    return bad


def employees_to_cells(spark, source, table, buckets):
    """Employee lines, quotes kept, as cells under the employee's number."""
    keyed_table.ensure_cells(spark, table, buckets)
    rows = parse_employee(read_lines(spark, source), quotes="keep")
    keyed_table.write_cells(spark, table, cells.employee_cells(rows))


def read_sensor_table(spark, table, encoding="text"):
    """A cell table as typed sensor rows."""
    return cells.decode_cells(keyed_table.read_table(spark, table), encoding)


def posts_to_table(spark, posts, table, buckets, max_len=None, on_long="fail", batch_id=None,
                   seq=None, stream="default"):
    """Upsert posts by id, of one id the last by ``seq``.

    ``max_len`` limits the characters of a text; ``on_long`` says what happens to a longer one:
    ``fail``, ``reject`` or ``truncate``, which cuts it. Returns the rejected rows, which are not
    written, or None.
    """
    schema = T.StructType([
        T.StructField("tweet_id", T.LongType()), T.StructField("tweet", T.StringType()),
        T.StructField("created_at", T.StringType())])
    keyed_table.ensure_table(spark, table, schema, ["tweet_id"], buckets)
    order = [seq] if seq else []
    rows = posts.select(F.col("id").alias("tweet_id"), F.col("text").alias("tweet"), "created_at",
                        *order)
    limits = {"tweet": max_len, "created_at": max_len} if max_len else None
    keyed_table.upsert(spark, table, rows, seq, batch_id=batch_id, stream=stream, max_len=limits,
                       on_long=on_long)
    return keyed_table.too_long(rows, limits) if limits and on_long == "reject" else None


# Streams ------------------------------------------------------------------------------

def alert_stream(rows, out, checkpoint, style="csv", trigger=ALERT_INTERVAL, **run):
    """Low-pressure rows to alert files."""

    def save(batch, i):
        sinks.append_alerts(alerts(batch), out, i, style,
                            stream_id(batch.sparkSession, checkpoint))

    return run_batches(rows, [save], checkpoint, trigger, **run)


def report_stream(rows, pump, maint, out, checkpoint, show=0, trigger=STATS_INTERVAL, devices=None,
                  buckets=64, **run):
    """Statistics, alerts with maintenance, and alert files of each batch.

    Device tables of a broadcast's size are kept once for all batches. Larger ones are written once by
    device, into ``buckets`` buckets, and removed at the end; a caller that keeps them for several
    runs hands them over as ``devices``, a ``joins.DeviceTables``, and ``pump`` and ``maint`` are
    not looked at.
    """
    made, kept = None, []
    if devices is None:
        strategy = joins.join_strategy(pump, maint)
        if set(strategy.values()) == {"broadcast"}:
            kept = [pump.persist(), maint.persist()]
        else:
            devices = made = joins.DeviceTables(pump, maint, buckets)

    def save(df, name, i):
        if show:
            sinks.preview(df, show)
        stream = stream_id(df.sparkSession, checkpoint)
        df.write.mode("overwrite").parquet(sinks.batch_folder(f"{out}/{name}", i, stream))

    def statistics(batch, i):
        save(stats.sensor_stats(batch), "stats", i)

    def maintenance(batch, i):
        low = alerts(batch)
        save(devices.view(low) if devices else joins.alert_maintenance_view(low, *kept, strategy),
             "view", i)

    def low(batch, i):
        sinks.append_alerts(alerts(batch), f"{out}/alerts", i,
                            stream=stream_id(batch.sparkSession, checkpoint))

    try:
        return run_batches(rows, [statistics, maintenance, low], checkpoint, trigger, **run)
    finally:
        for df in kept:
            df.unpersist()
        if made:
            made.drop()


def sensor_cells_stream(spark, rows, table, checkpoint, buckets, encoding="text", mode="both",
                        trigger=CELL_INTERVAL, **run):
    """Sensor rows to the data and alert families."""
    keyed_table.ensure_cells(spark, table, buckets, binary=encoding == "binary")

    def put(batch, i):
        keyed_table.write_cells(batch.sparkSession, table,
                                cells.route(cells.by_row(placed(batch), cells.sensor_key()), mode,
                                            encoding), batch_id=i,
                                stream=stream_id(batch.sparkSession, checkpoint))

    return run_batches(rows, [put], checkpoint, trigger, **run)


def vmstat_stream_to_table(spark, lines, table, checkpoint, buckets,
                           trigger=STATS_INTERVAL, **run):
    """Strict vmstat lines to a table keyed by cache size."""
    keyed_table.ensure_table(spark, table, schemas.VMSTAT, ["CACH"], buckets)
    rows = parse_vmstat(lines, "strict")
    seq = "seq" if "seq" in rows.columns else None

    def put(batch, i):
        keyed_table.upsert(batch.sparkSession, table, placed(batch), seq, batch_id=i,
                           stream=stream_id(batch.sparkSession, checkpoint))

    return run_batches(rows, [put], checkpoint, trigger, **run)


def vmstat_stream_to_cells(spark, lines, table, checkpoint, buckets,
                           trigger=CELL_INTERVAL, **run):
    """Lenient vmstat lines to cells under date and time."""
    keyed_table.ensure_cells(spark, table, buckets)
    rows = parse_vmstat(lines, "lenient")

    def put(batch, i):
        dealt = cells.by_row(placed(batch), cells.vmstat_key())
        keyed_table.write_cells(batch.sparkSession, table, cells.vmstat_cells(dealt), batch_id=i,
                                stream=stream_id(batch.sparkSession, checkpoint))

    return run_batches(rows, [put], checkpoint, trigger, **run)


def post_stream(spark, posts, terms, table, checkpoint, buckets, max_len=None, on_long="fail",
                trigger=STATS_INTERVAL, **run):
    """Posts with one of the terms to a table keyed by id; a ``seq`` of the posts orders them."""
    rows = project_posts(keyword_filter(posts, terms))
    seq = "seq" if "seq" in rows.columns else None

    def put(batch, i):
        posts_to_table(batch.sparkSession, placed(batch), table, buckets, max_len, on_long,
                       batch_id=i, seq=seq, stream=stream_id(batch.sparkSession, checkpoint))

    return run_batches(rows, [put], checkpoint, trigger, **run)


def window_stream(spark, rows, table, checkpoint, buckets, length="6 seconds", slide="2 seconds",
                  time="event", watermark="1 hour", trigger=STATS_INTERVAL, **run):
    """Sums of the panes of sliding windows, kept in a table; ``read_windows`` gives the windows.

    A batch writes only the panes it changed, each once, though it is in several windows. The
    query forgets panes that are past the ``watermark`` and leaves out rows that come later still;
    ``watermark=None`` takes rows however late, and its state then grows for ever.
    """
    grouped = stats.panes(rows, ["psi"], length, slide, time, watermark=watermark)
    keyed_table.ensure_table(spark, table, grouped.schema, ["p_start", *stats.BY], buckets)

    def put(batch, i):
        keyed_table.upsert(batch.sparkSession, table, batch, batch_id=i,
                           stream=stream_id(batch.sparkSession, checkpoint))

    return run_batches(grouped, [put], checkpoint, trigger, mode="update", **run)


def read_windows(spark, table, length="6 seconds", slide="2 seconds"):
    """Counts and psi statistics of sliding windows from the table of ``window_stream``."""
    return stats.windows_of_panes(keyed_table.read_table(spark, table), ["psi"], length, slide)


def arrival_window_stream(spark, rows, table, checkpoint, buckets, length="6 seconds",
                          slide="2 seconds", trigger=STATS_INTERVAL, **run):
    """Counts and psi statistics over the rows that arrived in the last ``length``, in a table.

    Run it every ``slide``; see ``arrival_windows``. Its windows go by the clock, so it has no end of
    its own: a stream that takes what is there would wait for the last window to pass.
    """
    if trigger is None:
        raise ValueError("windows by arrival need a trigger")
    grouped = arrival_windows(rows, ["psi"], length, slide)
    keyed_table.ensure_table(spark, table, grouped.schema, ["w_start", *stats.BY], buckets)

    def put(batch, i):
        keyed_table.upsert(batch.sparkSession, table, batch, batch_id=i,
                           stream=stream_id(batch.sparkSession, checkpoint))

    return run_batches(grouped, [put], checkpoint, trigger, mode="update", **run)
