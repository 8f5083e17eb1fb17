"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import schemas
from tidegauge.operators import cells, joins, keyed_table, sinks, stats
from tidegauge.operators.filters import alerts, keyword_filter
from tidegauge.operators.parse import (REST, bad_rows, counted, good_rows, parse_employee,
                                       parse_maint, parse_objects, parse_pump, parse_sensor,
                                       parse_vmstat, project_posts)
from tidegauge.plans import adapters, jobs
from tidegauge.plans.adapters import stream_table, table
from tidegauge.plans.avro_files import write_avro
from tidegauge.session import scratch_dir
from tidegauge.sources import files, read_employees, read_lines, stream_lines
from tidegauge.sources.clustered import drop_clustered, scan_ranges, write_clustered, write_ranges
from tidegauge.sources.employees import XML_TAGS
from tidegauge.streaming import batch_sql, run_batches

KEYWORDS = ["thing", "water"]
BUCKETS = 16  # folders of the tables that the queries write
WINDOW = {"length": "6 hours", "slide": "2 hours"}

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# Inputs -------------------------------------------------------------------------------

def _sensor(spark, sf, keep_seq=False):
    rows = parse_sensor(adapters.sensor_lines(table(spark, sf, "events")))
    return rows if keep_seq else rows.drop("seq")


def _pump(spark, sf):
    return parse_pump(adapters.pump_lines(table(spark, sf, "customer"),
                                          table(spark, sf, "nation")))


def _maint(spark, sf):
    return parse_maint(adapters.maint_lines(table(spark, sf, "orders")))


def _employees(spark, sf):
    return adapters.employees(table(spark, sf, "customer"))


def _vmstat(spark, sf, mode):
    lines = adapters.vmstat_lines(table(spark, sf, "events"), stamped=mode == "lenient")
    return parse_vmstat(lines, mode)


def _rounded(df):
    """Averages to six places: the order of summation shows in the last bits."""
    return df.select(*[F.round(c, 6).alias(c) if c.startswith("avg") else c
                       for c in df.columns])


# Parsing ------------------------------------------------------------------------------

@query
def parse_sensor_lines(spark, sf):
    return _sensor(spark, sf)


@query
def parse_pump_lines(spark, sf):
    return _pump(spark, sf)


@query
def parse_maint_lines(spark, sf):
    return _maint(spark, sf)


@query
def employees_csv_strip(spark, sf):
    return parse_employee(adapters.employee_lines(_employees(spark, sf), quoted=True), "strip")


@query
def employees_csv_keep(spark, sf):
    return parse_employee(adapters.employee_lines(_employees(spark, sf), quoted=False), "keep")


@query
def employees_json(spark, sf):
    path = scratch_dir(spark, "employees-json")
    _employees(spark, sf).write.json(path)
    return good_rows(read_employees(spark, path, "json"))


@query
def employees_xml(spark, sf):
    path = scratch_dir(spark, "employees-xml")
    _employees(spark, sf).write.format("xml").options(**XML_TAGS).save(path)
    return good_rows(read_employees(spark, path, "xml"))


@query
def employees_avro(spark, sf):
    path = scratch_dir(spark, "employees-avro")
    write_avro(_employees(spark, sf), path)
    return good_rows(read_employees(spark, path, "avro"))


@query
def vmstat_strict(spark, sf):
    return _vmstat(spark, sf, "strict").drop("seq")


@query
def vmstat_lenient(spark, sf):
    return _vmstat(spark, sf, "lenient").drop("seq")


def _spoiled(spark, sf):
    """Sensor lines of which those of the first hour lack their last field."""
    lines = adapters.sensor_lines(table(spark, sf, "events"))
    hour = F.substring(_field(",", 2), 1, 2)
    return lines.withColumn("value", F.when(
        hour == "00", F.regexp_replace("value", ",[^,]*$", "")).otherwise(F.col("value")))


@query
def permissive_good(spark, sf):
    return good_rows(parse_sensor(_spoiled(spark, sf), "permissive")).drop("seq")


@query
def permissive_bad(spark, sf):
    return bad_rows(parse_sensor(_spoiled(spark, sf), "permissive")).drop("seq")


def _drifting(spark, sf):
    """Employees as JSON lines: some have more fields, some a number that is none, some are cut."""
    rows = _employees(spark, sf)
    number = F.when(F.col("emp_no") % 7 == 0, F.concat(F.lit('"no '), "emp_no", F.lit('"'))).otherwise(
        F.col("emp_no").cast("string"))
    extra = F.when(F.col("emp_no") % 3 == 0, F.concat(F.lit(', "level": '), F.col("emp_no") % 10))
    names = [F.concat(F.lit(f', "{c}": "'), c, F.lit('"')) for c in rows.columns if c != "emp_no"]
    line = F.concat(F.lit('{"emp_no": '), number, *names, F.coalesce(extra, F.lit("")), F.lit("}"))
    cut = F.when(F.col("emp_no") % 11 == 0, F.substring(line, 1, 30)).otherwise(line)
    return rows.select(cut.alias("value"))


@query
def employees_drifting(spark, sf):
    rows = good_rows(parse_objects(_drifting(spark, sf), schemas.EMPLOYEE, "emp_no"))
    return rows.select(*schemas.EMPLOYEE.fieldNames(), F.try_element_at(REST, F.lit("level")).alias("level"))


@query
def employees_drifting_bad(spark, sf):
    return bad_rows(parse_objects(_drifting(spark, sf), schemas.EMPLOYEE, "emp_no"))


@query
def counted_lines(spark, sf):
    """Lines read, kept, bad and dropped by a lenient and a permissive parser, each in its one pass."""
    stamped = adapters.vmstat_lines(table(spark, sf, "events"), stamped=True)
    found = []
    for name, lines, parse, mode in (("vmstat", stamped, parse_vmstat, "lenient"),
                                     ("sensor", _spoiled(spark, sf), parse_sensor, "permissive")):
        rows, counts = counted(lines, parse, mode)
        rows.write.format("noop").mode("overwrite").save()
        found.append({"parser": name, **counts.get()})
    return spark.createDataFrame(found, "parser string, read long, kept long, bad long, dropped long")


# Filters ------------------------------------------------------------------------------

@query
def low_pressure_alerts(spark, sf):
    return alerts(_sensor(spark, sf))


@query
def keyword_posts(spark, sf):
    return project_posts(keyword_filter(adapters.posts(table(spark, sf, "documents")), KEYWORDS))


@query
def keyword_posts_many(spark, sf):
    """Posts with one of ten thousand terms, of which two occur, by a look-up of each token."""
    terms = KEYWORDS + [f"term{i}" for i in range(10_000)]
    return project_posts(keyword_filter(adapters.posts(table(spark, sf, "documents")), terms))


# Statistics ---------------------------------------------------------------------------

@query
def sensor_stats6(spark, sf):
    return _rounded(stats.sensor_stats(_sensor(spark, sf)))


@query
def sensor_counts(spark, sf):
    return stats.sensor_counts(_sensor(spark, sf))


@query
def psi_stats(spark, sf):
    return _rounded(stats.sensor_stats(_sensor(spark, sf), ["psi"]))


@query
def window_counts(spark, sf):
    return stats.windowed_counts(_sensor(spark, sf), **WINDOW)


@query
def window_psi(spark, sf):
    return _rounded(stats.windowed_stats(_sensor(spark, sf), **WINDOW))


# Join ---------------------------------------------------------------------------------

@query
def alert_maintenance(spark, sf):
    return joins.alert_maintenance_view(alerts(_sensor(spark, sf)), _pump(spark, sf),
                                        _maint(spark, sf))


@query
def alert_maintenance_spread(spark, sf):
    """The same join on the way taken when the device tables are too large to broadcast."""
    return joins.alert_maintenance_view(
        alerts(_sensor(spark, sf)), _pump(spark, sf), _maint(spark, sf),
        {"pump": "spread", "maint": "spread"})


# Cells --------------------------------------------------------------------------------

@query
def cells_text(spark, sf):
    return cells.encode_cells(_sensor(spark, sf), cells.sensor_key(), cells.SENSOR_TEXT)


@query
def cells_alert(spark, sf):
    return cells.encode_alert_cells(alerts(_sensor(spark, sf)))


@query
def cells_route_both(spark, sf):
    return cells.route(_sensor(spark, sf), "both")


@query
def cells_route_exclusive(spark, sf):
    return cells.route(_sensor(spark, sf), "exclusive")


@query
def cells_decode(spark, sf):
    return cells.decode_cells(cells.route(_sensor(spark, sf, keep_seq=True), "both"))


@query
def cells_decode_clustered(spark, sf):
    """The same from cells stored by row key: they are not shuffled to be put together."""
    written = cells.route(_sensor(spark, sf, keep_seq=True), "both")
    name = write_clustered(written, "row_key", BUCKETS)
    out = scratch_dir(spark, "decoded")
    cells.decode_cells(spark.table(name)).write.parquet(out)
    drop_clustered(spark, name)
    return spark.read.parquet(out)


def _cells_in_ranges(spark, sf):
    """The folder and schema of text cells stored in ranges of their row key."""
    written = cells.route(_sensor(spark, sf), "both")
    path = scratch_dir(spark, "cell-ranges")
    write_ranges(written, "row_key", path, BUCKETS, ["qualifier"])
    return path, written.schema


@query
def cells_scan_prefix(spark, sf):
    """Cells whose row key starts with a prefix, from the files of ranges that can hold them."""
    path, schema = _cells_in_ranges(spark, sf)
    return scan_ranges(spark, path, "row_key", schema, prefix="R12")


@query
def cells_scan_between(spark, sf):
    """Rows put together from the cells whose row key is between two bounds."""
    path, schema = _cells_in_ranges(spark, sf)
    found = scan_ranges(spark, path, "row_key", schema, low="R2", high="R3")
    return cells.project_family(found, "alert", ["psi"]).filter("psi is not null")


@query
def cells_project_family(spark, sf):
    written = cells.encode_cells(_sensor(spark, sf, keep_seq=True), cells.sensor_key(),
                                 cells.SENSOR_TEXT)
    return cells.project_family(written, "data", ["chlPPM", "flo"])


@query
def cells_binary(spark, sf):
    """Binary cells with their bytes as hex text."""
    coded = cells.route(_sensor(spark, sf), "both", "binary")
    return coded.withColumn("value", F.hex("value"))


@query
def cells_binary_roundtrip(spark, sf):
    coded = cells.route(_sensor(spark, sf, keep_seq=True), "both", "binary")
    return cells.decode_cells(coded, "binary")


@query
def cells_vmstat(spark, sf):
    return cells.vmstat_cells(_vmstat(spark, sf, "lenient")).drop("seq")


@query
def cells_employee(spark, sf):
    return cells.employee_cells(_employees(spark, sf))


# Keyed tables -------------------------------------------------------------------------

def _halves(rows):
    """Two batches that together are all rows, by the hour of the day."""
    late = F.col("chlPPM") >= 12
    return rows.filter(~late), rows.filter(late)


@query
def upsert_latest(spark, sf):
    """The newest row of each device after two batches, the second one winning."""
    path = scratch_dir(spark, "latest")
    keyed_table.ensure_table(spark, path, schemas.SENSOR, ["resid"], BUCKETS)
    for batch in _halves(_sensor(spark, sf, keep_seq=True)):
        keyed_table.upsert(spark, path, batch, seq="seq")
    return keyed_table.read_table(spark, path)


@query
def upsert_vmstat_by_cach(spark, sf):
    path = scratch_dir(spark, "vmstat")
    keyed_table.ensure_table(spark, path, schemas.VMSTAT, ["CACH"], BUCKETS)
    keyed_table.upsert(spark, path, _vmstat(spark, sf, "strict"), seq="seq")
    return keyed_table.read_table(spark, path)


@query
def upsert_employees(spark, sf):
    """The CSV job end to end: quoted lines, parse, upsert, read back."""
    lines = scratch_dir(spark, "employee-lines")
    adapters.employee_lines(_employees(spark, sf), quoted=True).write.text(lines)
    path = scratch_dir(spark, "employees")
    jobs.employees_to_table(spark, lines, "csv", path, BUCKETS)
    return keyed_table.read_table(spark, path)


@query
def upsert_employee_cells(spark, sf):
    """The job from employee lines to cells, read back."""
    lines, path = scratch_dir(spark, "employee-lines"), scratch_dir(spark, "employee-cells")
    adapters.employee_lines(_employees(spark, sf), quoted=False).write.text(lines)
    jobs.employees_to_cells(spark, lines, path, BUCKETS)
    return keyed_table.read_table(spark, path)


@query
def upsert_subset_columns(spark, sf):
    """A batch without last_name: stored names stay, new employees have none.

    A number that both a customer and a supplier give keeps what the supplier, who comes later, says.
    """
    path = scratch_dir(spark, "employees")
    keyed_table.ensure_table(spark, path, schemas.EMPLOYEE, ["emp_no"], BUCKETS)
    keyed_table.upsert(spark, path, _employees(spark, sf))
    nation = table(spark, sf, "nation")

    def changed(df, key, nationkey, turn):
        return df.join(nation, F.col(nationkey) == F.col("n_nationkey")).select(
            key.cast("bigint").alias("emp_no"), F.lit("1970-01-01").alias("birth_date"),
            F.col("n_name").alias("first_name"), F.lit("X").alias("gender"),
            F.lit("2000-01-01").alias("hire_date"), F.lit(turn).alias("turn"))

    old = changed(table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING"),
                  F.col("c_custkey"), "c_nationkey", 0)
    new = changed(table(spark, sf, "supplier"), -F.col("s_suppkey"), "s_nationkey", 1)
    keyed_table.upsert(spark, path, old.unionByName(new), seq="turn",
                       columns=["emp_no", "birth_date", "first_name", "gender", "hire_date"])
    return keyed_table.read_table(spark, path)


@query
def upsert_cells(spark, sf):
    """Cells of two batches: a cell keeps its last write."""
    path = scratch_dir(spark, "cells")
    keyed_table.ensure_cells(spark, path, BUCKETS)
    for batch in _halves(_sensor(spark, sf, keep_seq=True)):
        keyed_table.write_cells(spark, path, cells.route(batch, "both"))
    return keyed_table.read_table(spark, path)


@query
def upsert_posts(spark, sf):
    """Posts with a keyword, texts of any length."""
    path = scratch_dir(spark, "posts")
    found = keyword_filter(adapters.posts(table(spark, sf, "documents")), ["the", "de"])
    jobs.posts_to_table(spark, project_posts(found), path, BUCKETS)
    return keyed_table.read_table(spark, path)


@query
def table_head(spark, sf):
    path = scratch_dir(spark, "employees")
    keyed_table.ensure_table(spark, path, schemas.EMPLOYEE, ["emp_no"], BUCKETS)
    keyed_table.upsert(spark, path, _employees(spark, sf))
    return keyed_table.table_head(spark, path, 5)


# Streaming ----------------------------------------------------------------------------

def _to_parquet(path):
    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return sink


def _sensor_stream(spark, sf):
    return parse_sensor(adapters.sensor_lines(stream_table(spark, sf, "events")))


def _publish(lines, landing, key):
    """Lines to a landing folder, those of one key in one file and in order."""
    placed = lines.withColumn("key", key).repartition("key").sortWithinPartitions("key", "seq")
    sinks.publish(placed, landing)


def _in_turns(spark, sf, lines, hours, key, take):
    """Publishes the lines of each span of hours of the day and lets ``take`` read them.

    ``lines`` makes lines of events. Files of a later turn are newer, so rows arrive by turn and
    then by ``seq``. Every event is in one of the turns.
    """
    landing = scratch_dir(spark, "landing")
    events = table(spark, sf, "events")
    for low, high in zip(hours, [*hours[1:], 24]):
        turn = (F.hour("ts") >= low) & (F.hour("ts") < high)
        _publish(lines(events.filter(turn)), landing, key)
        take(stream_lines(spark, landing))
    return landing


def _field(sep, n):
    return F.get(F.split("value", sep), F.lit(n))


def _token(n):
    """Token n, from 1, of a vmstat line."""
    return F.get(F.split(F.ltrim("value"), " +"), F.lit(n - 1))


TURNS = [0, 8, 16]
DEVICE_BUCKETS = 16


def _view_schema(pump, maint):
    """The schema of alerts with their pump and maintenance records."""
    fields = {f.name: f for df in (maint, pump) for f in df.schema} | {
        f.name: f for f in schemas.SENSOR}
    return T.StructType([fields[c] for c in joins.VIEW])


def _batches(spark, path, schema):
    return spark.read.schema(schema).parquet(path).drop("batch_id")


@query
def publish_sensor_lines(spark, sf):
    """Lines published into a landing folder, as a stream's reader finds them."""
    landing = scratch_dir(spark, "landing")
    sinks.publish(adapters.sensor_lines(table(spark, sf, "events")), landing)
    return read_lines(spark, landing)


@query
def stream_batch_stats(spark, sf):
    """Statistics of each batch of a stream that is stopped and started again twice."""
    out, state = scratch_dir(spark, "stats"), scratch_dir(spark, "stats-state")
    shape = stats.sensor_stats(_sensor(spark, sf)).schema

    def per_batch(batch, batch_id):
        _to_parquet(out)(stats.sensor_stats(batch), batch_id)

    _in_turns(spark, sf, adapters.sensor_lines, TURNS, _field(",", 0),
              lambda lines: run_batches(parse_sensor(lines), [per_batch], state))
    batches = spark.read.schema(shape.add("batch_id", "long")).parquet(out)
    return _rounded(batches)


@query
def stream_alerts(spark, sf):
    out, state = scratch_dir(spark, "alerts"), scratch_dir(spark, "alerts-state")
    jobs.alert_stream(_sensor_stream(spark, sf), out, state, trigger=None)
    return spark.read.schema(schemas.SENSOR).csv(out).drop("query", "batch_id")


@query
def stream_alert_maintenance(spark, sf):
    """A SQL statement on each batch's alerts beside two static tables, stored by device."""
    out, state = scratch_dir(spark, "view"), scratch_dir(spark, "view-state")
    pump, maint = _pump(spark, sf), _maint(spark, sf)
    tables = {name: write_clustered(df, "resid", DEVICE_BUCKETS)
              for name, df in (("pump", pump), ("maint", maint))}
    statement = f"""
        select {', '.join(('p.' if c in joins.PUMP_COLUMNS else 'm.' if c in joins.MAINT_COLUMNS
                           else 'a.') + c for c in joins.VIEW)}
        from alert a join pump p on a.resid = p.resid join maint m on p.resid = m.resid"""
    sql = batch_sql("alert", statement, _to_parquet(out), tables, "resid")
    run_batches(alerts(_sensor_stream(spark, sf)), [sql], state)
    for name in tables.values():
        drop_clustered(spark, name)
    return _batches(spark, out, _view_schema(pump, maint))


@query
def stream_alert_devices(spark, sf):
    """The same view by device tables that two restarts of a stream share."""
    out, state = scratch_dir(spark, "view"), scratch_dir(spark, "view-state")
    pump, maint = _pump(spark, sf), _maint(spark, sf)
    devices = joins.DeviceTables(pump, maint, DEVICE_BUCKETS)

    def take(lines):
        jobs.report_stream(parse_sensor(lines), None, None, out, state, trigger=None,
                           devices=devices)

    _in_turns(spark, sf, adapters.sensor_lines, TURNS, _field(",", 0), take)
    devices.drop()
    return spark.read.schema(_view_schema(pump, maint)).parquet(f"{out}/view").drop(
        "query", "batch_id")


@query
def alert_maintenance_devices(spark, sf):
    """The same join with tables stored by device, as for a batch of very many devices."""
    devices = joins.DeviceTables(_pump(spark, sf), _maint(spark, sf), DEVICE_BUCKETS)
    out = scratch_dir(spark, "view")
    devices.view(alerts(_sensor(spark, sf)), most=10).write.parquet(out)
    devices.drop()
    return spark.read.parquet(out)


@query
def stream_cells(spark, sf):
    """Two streams fill both families of one cell table, and a restart adds nothing.

    The second stream reads all lines, the first those of the first half day; a cell keeps
    what arrived last.
    """
    path = scratch_dir(spark, "cells")
    states = [scratch_dir(spark, "cells-state") for _ in range(2)]
    later = iter(states)

    def take(lines):
        jobs.sensor_cells_stream(spark, parse_sensor(lines), path, next(later), BUCKETS,
                                 trigger=None)

    landing = _in_turns(spark, sf, adapters.sensor_lines, [0, 12], F.concat_ws("_", *[
        _field(",", i) for i in range(3)]), take)
    jobs.sensor_cells_stream(spark, parse_sensor(stream_lines(spark, landing)), path, states[1],
                             BUCKETS, trigger=None)
    return keyed_table.read_table(spark, path)


@query
def stream_cells_read_back(spark, sf):
    """Binary cells written by a stream and read back as sensor rows."""
    path, state = scratch_dir(spark, "cells"), scratch_dir(spark, "cells-state")
    jobs.sensor_cells_stream(spark, _sensor_stream(spark, sf), path, state, BUCKETS,
                             encoding="binary", trigger=None)
    return jobs.read_sensor_table(spark, path, "binary")


@query
def stream_once(spark, sf):
    """Counts of a stream of binary message bodies, half of whose files are delivered twice."""
    first, state = scratch_dir(spark, "bodies"), scratch_dir(spark, "bodies-state")
    landing, out = scratch_dir(spark, "bodies-landing"), scratch_dir(spark, "bodies-counts")
    lines = adapters.sensor_lines(table(spark, sf, "events"))
    bodies = lines.select(F.encode("value", "UTF-8").alias("body"))
    for part, rows in enumerate(bodies.randomSplit([1.0, 1.0], 7)):
        rows.write.parquet(f"{first}/{part}")
    for turn, part in (("a", 0), ("b", 0), ("b", 1)):  # the first half comes in both turns
        files.copy_tree(spark, f"{first}/{part}", f"{landing}/{turn}/{part}")
    lines = stream_lines(spark, landing, "parquet", "body", bodies.schema, once="1 hour",
                         recursiveFileLookup="true")

    def count(batch, batch_id):
        _to_parquet(out)(stats.sensor_counts(batch), batch_id)

    run_batches(parse_sensor(lines), [count], state)
    counted = spark.read.parquet(out)
    return counted.groupBy(*stats.BY).agg(F.sum("total").alias("total"))


@query
def stream_vmstat(spark, sf):
    path, state = scratch_dir(spark, "vmstat"), scratch_dir(spark, "vmstat-state")
    _in_turns(spark, sf, adapters.vmstat_lines, [0], _token(6),
              lambda lines: jobs.vmstat_stream_to_table(spark, lines, path, state, BUCKETS,
                                                          trigger=None))
    return keyed_table.read_table(spark, path)


@query
def stream_vmstat_cells(spark, sf):
    path, state = scratch_dir(spark, "vmstat"), scratch_dir(spark, "vmstat-state")
    _in_turns(spark, sf, lambda events: adapters.vmstat_lines(events, stamped=True), [0],
              F.concat_ws(" ", _token(18), _token(19)),
              lambda lines: jobs.vmstat_stream_to_cells(spark, lines, path, state, BUCKETS,
                                                          trigger=None))
    return keyed_table.read_table(spark, path)


@query
def stream_posts(spark, sf):
    """Posts with a keyword from a stream, by id; the rows' order is that of the files."""
    path, state = scratch_dir(spark, "posts"), scratch_dir(spark, "posts-state")
    posts = adapters.posts(stream_table(spark, sf, "documents"))
    jobs.post_stream(spark, posts, KEYWORDS, path, state, BUCKETS, trigger=None)
    return keyed_table.read_table(spark, path)


@query
def stream_report(spark, sf):
    """Alerts with maintenance as the report job writes them, beside statistics and alerts."""
    out, state = scratch_dir(spark, "report"), scratch_dir(spark, "report-state")
    jobs.report_stream(_sensor_stream(spark, sf), _pump(spark, sf), _maint(spark, sf), out, state,
                       trigger=None)
    return spark.read.parquet(f"{out}/view").drop("query", "batch_id")


@query
def stream_window_counts(spark, sf):
    """Running window counts: each batch upserts the panes it changed, windows are made of those."""
    path, state = scratch_dir(spark, "windows"), scratch_dir(spark, "windows-state")
    jobs.window_stream(spark, _sensor_stream(spark, sf), path, state, BUCKETS, trigger=None,
                       **WINDOW)
    return jobs.read_windows(spark, path, **WINDOW).select("w_start", *stats.BY, "total")


def queries():
    return dict(QUERIES)


def flagship(spark, sf):
    return alert_maintenance(spark, sf)


__all__ = ["queries", "flagship"]
