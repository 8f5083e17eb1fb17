import glob
import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from tidegauge import schemas, session
from tidegauge.operators import joins, keyed_table, sinks, stats
from tidegauge.operators.parse import bad_rows, good_rows, parse_maint, parse_pump, parse_sensor
from tidegauge.plans import jobs
from tidegauge.plans.avro_files import write_avro
from tidegauge.sources import (kafka_options, message_text, read_employees, read_lines,
                               stream_lines, widen)
from tidegauge.sources.clustered import drop_clustered, scan_ranges, write_clustered, write_ranges
from tidegauge.sources.employees import XML_TAGS
from tidegauge.streaming import (arrival_windows, batch_sql, run_batches, start_batches,
                                 stream_id)

PEOPLE = [(1, "1960-01-01", "Ann", "O'Neil & Co", "F", "1990-01-01"),
          (2, "1961-01-01", "Bö", "<x>", "M", "1991-01-01")]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, schemas.EMPLOYEE)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("fmt", ["json", "xml", "avro", "csv"])
def test_employee_formats(spark, people, tmp_path, fmt):
    path = str(tmp_path / fmt)
    if fmt == "json":
        people.write.json(path)
    elif fmt == "xml":
        people.write.format("xml").options(**XML_TAGS).save(path)
    elif fmt == "avro":
        write_avro(people.withColumn("emp_no", F.col("emp_no").cast("int")).repartition(3), path)
    else:
        people.select(F.concat_ws(",", *people.columns)).write.text(path)
    df = read_employees(spark, path, fmt)
    df = good_rows(df) if fmt != "csv" else df
    assert [(f.name, f.dataType) for f in df.schema] == \
        [(f.name, f.dataType) for f in schemas.EMPLOYEE]
    assert got(df) == PEOPLE


def test_json_without_number(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"first_name": "Ann"}) + "\n"
                                     + json.dumps({"emp_no": 3, "first_name": "Bob"}))
    df = read_employees(spark, str(tmp_path), "json")
    assert [r["emp_no"] for r in good_rows(df).collect()] == [3]
    assert "Ann" in bad_rows(df).first()["_bad"]
    zero = read_employees(spark, str(tmp_path), "json", null_key="zero")
    assert sorted(r["emp_no"] for r in zero.collect()) == [0, 3]


def test_xml_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [f"<employee>\n<emp_no>{i}</emp_no><first_name>A &amp; <![CDATA[</x>]]> {i}</first_name></employee>\n"
            for i in range(200)]
    odd = ['<employee a="x>y" ><emp_no>-1</emp_no><!-- c --></employee >', "<employee/>", '<employee b="1"/>',
           "<employee><emp_no>-2</emp_no><note><n>1</n></note></employee>"]
    text = "<?xml version='1.0'?>\n<!-- c -->\n<employees>\n" + "".join([*rows, *odd]) + "</employees>\n"
    (tmp_path / "e.xml").write_text(text)
    small = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        df = read_employees(spark, str(tmp_path / "e.xml"), "xml")
        assert df.rdd.getNumPartitions() >= 8
        found = {r.emp_no: r.first_name for r in good_rows(df).collect()}
        assert found == {**{i: f"A & </x> {i}" for i in range(200)}, -1: None, -2: None}
        assert bad_rows(df).count() == 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("text", [
    "<employees><employee><emp_no>1</emp_no></employees>", "<employees><employee><emp_no>1</emp_no>",
    "<employees><employee><emp_no>one</emp_no></employee></employees>",
    "<employees><!-- <employee><emp_no>1</emp_no></employee> --></employees>"])
def test_xml_that_cannot_be_bound_fails(spark, tmp_path, text):
    (tmp_path / "e.xml").write_text(text)
    with pytest.raises(Exception):
        read_employees(spark, str(tmp_path / "e.xml"), "xml").collect()


def test_json_of_wrong_type_fails(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"emp_no": "three"}')
    with pytest.raises(Exception):
        read_employees(spark, str(tmp_path), "json").collect()


def test_employee_jobs(spark, people, tmp_path):
    table, source = str(tmp_path / "table"), str(tmp_path / "people.csv")
    people.select(F.concat_ws(",", *[F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
                                     for c in people.columns])).write.text(source)
    jobs.employees_to_table(spark, source, "csv", table, 4)
    assert got(keyed_table.read_table(spark, table)) == PEOPLE
    changed = people.withColumn("last_name", F.lit("new")).withColumn("gender", F.lit("X"))
    write_avro(changed.withColumn("emp_no", F.col("emp_no").cast("int")), str(tmp_path / "a"))
    jobs.employees_to_table(spark, str(tmp_path / "a"), "avro", table, 4)
    assert got(keyed_table.read_table(spark, table)) == \
        [(*p[:4], "X", p[5]) for p in PEOPLE]
    plain = str(tmp_path / "plain")
    people.select(F.concat_ws(",", *people.columns)).write.text(plain)
    jobs.employees_to_cells(spark, plain, str(tmp_path / "cells"), 4)
    cells = keyed_table.read_table(spark, str(tmp_path / "cells"))
    assert cells.count() == 12
    assert cells.filter("row_key = '1' and qualifier = 'first_name'").first()["value"] == "Ann"


def test_kafka_options():
    assert kafka_options("h:1", "a, b", "g", 2, startingOffsets="latest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "kafka.group.id": "g",
        "minPartitions": "4", "startingOffsets": "latest"}
    with pytest.raises(ValueError):
        kafka_options("h:1", " ,")


def test_messages_delivered_again_are_dropped(spark, tmp_path):
    rows = spark.createDataFrame([(f"{line(i, i)}".encode(),) for i in range(6)], "body binary")
    rows.coalesce(1).write.parquet(str(tmp_path / "made"))
    rows.coalesce(1).write.parquet(str(tmp_path / "same"))  # equal bodies, other messages
    landing = tmp_path / "landing"
    state, out = str(tmp_path / "state"), []

    def take(once="1 hour"):
        lines = stream_lines(spark, str(landing), "parquet", "body", rows.schema, once=once,
                             recursiveFileLookup="true")
        run_batches(lines, [lambda b, i: out.extend(r["value"] for r in b.collect())], state,
                    timeout=100)
        return len(out)

    shutil.copytree(tmp_path / "made", landing / "a")
    assert take() == 6 and sorted(out)[0].startswith("R0,2024-01-01")
    shutil.copytree(tmp_path / "made", landing / "b")  # after a restart, in a later batch
    assert take() == 6
    shutil.copytree(tmp_path / "same", landing / "c")
    shutil.copytree(tmp_path / "same", landing / "d")  # twice in one batch
    assert take() == 12
    with pytest.raises(ValueError, match="identity"):
        stream_lines(spark, str(landing), once="1 hour")


def test_scans_of_ranges_open_their_files_only(spark, tmp_path):
    """Prefixes and bounds against a plain filter; a hot key is split over ranges, null keys stay."""
    keys = [f"R{i % 97}_{i}" for i in range(3000)] + ["R5_hot"] * 1500 + ["é", "", "R", None, None]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")
    path = str(tmp_path / "ranges")
    write_ranges(rows, "k", path, 12, ["v"])
    assert got(spark.read.parquet(f"{path}/rows").select("v")) == [(i,) for i in range(len(keys))]

    def scanned(**bounds):
        return scan_ranges(spark, path, "k", rows.schema, **bounds)

    for bounds, rule in (
            ({"prefix": "R5_"}, lambda k: k.startswith("R5_")), ({"prefix": "R"}, lambda k: k.startswith("R")),
            ({"prefix": ""}, lambda k: True), ({"prefix": "é"}, lambda k: k == "é"),
            ({"prefix": "S"}, lambda k: False), ({"prefix": "R9", "high": "R93"}, lambda k: "R9" <= k < "R93"),
            ({"low": "R5_hot", "high": "R5_hou"}, lambda k: k == "R5_hot"),
            ({"low": "R90"}, lambda k: k >= "R90"), ({"high": "R10_1"}, lambda k: k < "R10_1")):
        want = sorted((k, i) for i, k in enumerate(keys) if k is not None and rule(k))
        assert got(scanned(**bounds)) == want, bounds
    assert scanned().count() == len(keys)
    for file in glob.glob(f"{path}/rows/*/*.parquet"):
        held = [r["k"] or "" for r in spark.read.parquet(file).collect()]
        assert held == sorted(held)
    every = len(spark.read.parquet(f"{path}/rows").inputFiles())
    assert len(scanned(prefix="R77_").inputFiles()) == 1 < every == 12
    assert len(scanned(low="R5_hot", high="R5_hou").inputFiles()) > 2
    assert "StringStartsWith(k,R77_)" in scanned(prefix="R77_")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_empty_ranges(spark, tmp_path):
    none = spark.createDataFrame([], "k string, v int")
    write_ranges(none, "k", str(tmp_path / "none"), 4)
    assert scan_ranges(spark, str(tmp_path / "none"), "k", none.schema, prefix="R").count() == 0
    assert scan_ranges(spark, str(tmp_path / "none"), "k", none.schema).count() == 0


def test_message_text(spark):
    df = spark.sql("select encode('é', 'UTF-8') body, 'k' key")
    assert message_text(df, "body").first()["value"] == "é"
    out = sinks.message_rows(spark.createDataFrame([("x",)], "value string"))
    assert out.dtypes == [("key", "binary"), ("value", "string")]
    assert tuple(out.first()) == (None, "x")


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "yarn"

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(), "x")
    assert session.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def line(i, psi):
    return f"R{i % 2},2024-01-01,00:00:{i:02d},1,2,3,4,{psi},6"


@pytest.fixture
def landing(spark, tmp_path):
    """Four files of two lines each."""
    path = tmp_path / "landing"
    path.mkdir()
    for n in range(4):
        (path / f"{n}.txt").write_text("\n".join(line(2 * n + j, n + 3.5) for j in (0, 1)))
        # Streams take files by age; these are written within one tick of the clock.
        os.utime(path / f"{n}.txt", (1_700_000_000 + n, 1_700_000_000 + n))
    return str(path)


def stream(spark, landing):
    return parse_sensor(stream_lines(spark, landing, maxFilesPerTrigger=1))


def test_statistics_are_per_batch(spark, landing, tmp_path):
    out = str(tmp_path / "out")

    def sink(batch, i):
        stats.sensor_counts(batch).write.mode("overwrite").parquet(f"{out}/batch_id={i}")

    assert run_batches(stream(spark, landing), [sink], str(tmp_path / "state"), timeout=120)
    df = spark.read.parquet(out)
    assert df.count() == 8 and {r["total"] for r in df.collect()} == {1}
    # Nothing new: a second run has no batch.
    run_batches(stream(spark, landing), [sink], str(tmp_path / "state"))
    assert spark.read.parquet(out).count() == 8


def test_interval_trigger_stops_at_timeout(spark, landing, tmp_path):
    seen = []
    ended = run_batches(stream(spark, landing), [lambda batch, i: seen.append(batch.count())],
                        str(tmp_path / "state"), trigger="1 second", timeout=12)
    assert not ended and sum(seen) == 8


@pytest.mark.parametrize("style,first", [("csv", "R0,2024-01-01,"), ("text", "Sensor(R0,2024")])
def test_alert_stream(spark, landing, tmp_path, style, first):
    out = str(tmp_path / "alerts")
    jobs.alert_stream(stream(spark, landing), out, str(tmp_path / "state"), style, trigger=None)
    written = sorted(r[0] for r in spark.read.text(out).select("value").collect())
    assert len(written) == 4 and written[0].startswith(first)
    again = parse_sensor(read_lines(spark, f"{landing}/0.txt"))
    query = stream_id(spark, str(tmp_path / "state"))
    sinks.append_alerts(again, out, 0, style, query)  # a batch that runs again
    assert spark.read.text(out).count() == 4


def test_report_stream(spark, landing, tmp_path):
    pump = parse_pump(spark.sql("select 'R0,HP,2010,2011,ACME,1,2' value"))
    maint = parse_maint(spark.sql("select explode(array('R0,d1,t,x', 'R0,d2,t,x')) value"))
    out = str(tmp_path / "out")
    jobs.report_stream(stream(spark, landing), pump, maint, out, str(tmp_path / "state"), show=2,
                       trigger=None)
    view = spark.read.parquet(f"{out}/view").drop("query", "batch_id")
    assert view.columns == joins.VIEW and view.count() == 4  # two R0 alerts, two events each
    assert spark.read.parquet(f"{out}/stats").count() == 8
    assert spark.read.csv(f"{out}/alerts").count() == 4


def test_sql_on_batches_with_static_view(spark, landing, tmp_path):
    spark.sql("select 'R0' resid, 'ACME' vendor").createOrReplaceTempView("static_pump")
    out = str(tmp_path / "out")

    def sink(df, i):
        df.write.mode("overwrite").parquet(f"{out}/batch_id={i}")

    sql = batch_sql("sensor", "select resid, vendor, max(psi) top from sensor "
                    "join static_pump using (resid) group by all", sink)
    run_batches(stream(spark, landing), [sql], str(tmp_path / "state"))
    assert sorted(r["top"] for r in spark.read.parquet(out).collect()) == [3.5, 4.5, 5.5, 6.5]


@pytest.mark.parametrize("most", [1, 100])
def test_sql_on_batches_with_tables_by_device(spark, landing, tmp_path, most):
    spark.sql("select 'mine' x").createOrReplaceTempView("pump")
    pump = write_clustered(spark.sql("select explode(array('R0', 'R7', null)) resid, 'ACME' vendor"),
                           "resid", 4)
    seen = []

    def sink(df, i):
        seen.extend(tuple(r) for r in df.collect())

    sql = batch_sql("sensor", "select resid, vendor, psi, (select count(*) from pump) n from sensor "
                    "join pump using (resid)", sink, {"pump": pump}, "resid", most)
    run_batches(stream(spark, landing), [sql], str(tmp_path / "state"))
    assert sorted(seen) == [("R0", "ACME", p + 0.5, 3 if most == 1 else 1) for p in (3, 4, 5, 6)]
    assert spark.table("pump").first()[0] == "mine"
    drop_clustered(spark, pump)
    spark.catalog.dropTempView("pump")


def test_report_stream_with_tables_by_device(spark, landing, tmp_path, monkeypatch):
    pump = parse_pump(spark.sql("select 'R0,HP,2010,2011,ACME,1,2' value"))
    maint = parse_maint(spark.sql("select explode(array('R0,d1,t,x', 'R0,d2,t,x')) value"))
    monkeypatch.setattr(joins, "join_strategy", lambda *a: {"pump": "spread", "maint": "spread"})
    out, before = str(tmp_path / "out"), spark.catalog.listTables()
    jobs.report_stream(stream(spark, landing), pump, maint, out, str(tmp_path / "state"),
                       trigger=None, buckets=4)
    view = spark.read.parquet(f"{out}/view").drop("query", "batch_id")
    assert view.columns == joins.VIEW and view.count() == 4
    assert len(spark.catalog.listTables()) == len(before)


@pytest.mark.parametrize("encoding", ["text", "binary"])
def test_cells_stream_and_read_back(spark, landing, tmp_path, encoding):
    table = str(tmp_path / "cells")
    for _ in range(2):  # with a new checkpoint the same batches come again
        jobs.sensor_cells_stream(spark, stream(spark, landing), table,
                                 str(tmp_path / f"state-{_}"), 4, encoding, trigger=None)
    df = jobs.read_sensor_table(spark, table, encoding)
    expected = [(f"R{i % 2}_2024-01-01 00:00:{i:02d}", i // 2 + 3.5) for i in range(8)]
    assert sorted((r["key"], r["psi"]) for r in df.collect()) == sorted(expected)


def test_window_stream_equals_batch(spark, landing, tmp_path):
    table = str(tmp_path / "windows")
    jobs.window_stream(spark, stream(spark, landing), table, str(tmp_path / "state"), 4,
                       trigger=None)
    batch = stats.windowed_report(parse_sensor(read_lines(spark, landing)))
    assert got(jobs.read_windows(spark, table)) == got(batch)


def test_windows_by_arrival_against_all_batches(spark, tmp_path):
    folder, out = tmp_path / "landing", []
    folder.mkdir()
    batches = [[("R0", 1.0), ("R0", 3.0), ("R1", 2.0)], [("R0", 5.0)], [("R1", 7.0), ("R2", 1.0)],
               [("R2", 4.0)] * 50, [("R0", None), (None, 2.0)]]
    schema = "resid string, date string, psi double"

    def sink(df, i):
        out.append((i, df.collect()))

    rows = arrival_windows(spark.readStream.schema(schema).json(str(folder)), ["psi"],
                           "3 seconds", "1 second")
    query = start_batches(rows, [sink], str(tmp_path / "state"), "1 second", mode="update")
    try:
        for n, batch in enumerate(batches):
            (folder / f".{n}").write_text("\n".join(
                json.dumps({"resid": r, "date": "d", "psi": p}) for r, p in batch))
            (folder / f".{n}").rename(folder / f"{n}.json")
            taken = lambda: sum(p["numInputRows"] for p in query.recentProgress)
            end = time.time() + 60
            while taken() < sum(map(len, batches[:n + 1])) and time.time() < end:
                time.sleep(0.1)
        end = time.time() + 30
        while query.lastProgress["stateOperators"][0]["numRowsTotal"] and time.time() < end:
            time.sleep(0.2)
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 0  # nothing is kept
        ids = {p["batchId"]: p["numInputRows"] for p in query.recentProgress}
    finally:
        query.stop()
    fed = [i for i in sorted(ids) if ids[i]]  # the batches that had rows, one file each
    assert [ids[i] for i in fed] == [len(b) for b in batches]
    pane = {i: int(r[0]["w_start"].timestamp()) + 2 for i, r in out}  # of the batch
    content = {i: b for i, b in zip(fed, batches, strict=True)}
    for i, found in out:
        want = {}
        for j, b in content.items():
            if j <= i and pane[j] > pane[i] - 3:
                for r, p in b:
                    want.setdefault(r, []).append(p)
        assert len({r["w_start"] for r in found}) == 1
        for r in found:
            values = [p for p in want[r["resid"]] if p is not None]
            assert r["total"] == (0 if r["resid"] is None else len(want[r["resid"]]))
            assert (r["maxpsi"], r["minpsi"]) == (
                max(values, default=None), min(values, default=None))
            assert r["avgpsi"] == (
                pytest.approx(sum(values) / len(values)) if values else None)
        assert {r for r, _ in content.get(i, [])} <= {r["resid"] for r in found} <= set(want)
    # Groups without new rows are told of again in later panes.
    assert any(i not in content for i, _ in out)


def test_lengths_of_arrival_windows(spark):
    stream = spark.readStream.format("rate").load().selectExpr(
        "'a' resid", "'d' date", "1d psi")
    with pytest.raises(ValueError, match="multiple"):
        arrival_windows(stream, length="5 seconds", slide="2 seconds")


def test_arrival_windows_to_a_table(spark, landing, tmp_path):
    table, state = str(tmp_path / "windows"), str(tmp_path / "state")
    with pytest.raises(ValueError, match="trigger"):
        jobs.arrival_window_stream(spark, stream(spark, landing), table, state, 4, trigger=None)
    jobs.arrival_window_stream(spark, stream(spark, landing), table, state, 4, length="6 hours",
                               slide="2 hours", trigger="1 second", timeout=15)
    found = keyed_table.read_table(spark, table).collect()
    assert {r["resid"] for r in found} == {"R0", "R1"}
    last = max(r["w_start"] for r in found)
    assert {(r["total"], r["maxpsi"], r["minpsi"]) for r in found if r["w_start"] == last} == {
        (4, 6.5, 3.5)}


def test_watermarked_append_windows(spark, landing, tmp_path):
    out = str(tmp_path / "out")
    windows = stats.windowed_counts(stream(spark, landing), watermark="0 seconds")
    run_batches(windows, [lambda b, i: b.write.parquet(f"{out}/batch_id={i}")],
                str(tmp_path / "state"))
    closed = {str(r["w_start"]) for r in spark.read.parquet(out).collect()}
    assert "2023-12-31 23:59:56" in closed and "2024-01-01 00:00:06" not in closed


def test_vmstat_and_post_streams(spark, tmp_path):
    folder = tmp_path / "vm"
    folder.mkdir()
    tokens = "  ".join(str(i) for i in range(1, 18))
    (folder / "a.txt").write_text(f"r b buff cache\n {tokens}\n")
    table = str(tmp_path / "vmstat")
    jobs.vmstat_stream_to_table(spark, stream_lines(spark, str(folder)), table,
                                str(tmp_path / "s1"), 4, trigger=None)
    assert got(keyed_table.read_table(spark, table)) == [tuple(str(i) for i in range(1, 18))]
    (folder / "a.txt").write_text(f" {tokens} 2024-01-01 10:00:00\n {tokens}\n")
    jobs.vmstat_stream_to_cells(spark, stream_lines(spark, str(folder)),
                                str(tmp_path / "vmcells"), str(tmp_path / "s2"), 4, trigger=None)
    cells = keyed_table.read_table(spark, str(tmp_path / "vmcells"))
    assert cells.count() == 16 and {r[0] for r in cells.collect()} == {"2024-01-01 10:00:00"}
    spark.sql("select 1L id, 'about India' text, 'today' created_at union all "
              "select 2, 'Indiana', 'today'").coalesce(1).write.parquet(str(tmp_path / "posts"))
    posts = spark.readStream.schema(schemas.POST).parquet(str(tmp_path / "posts"))
    jobs.post_stream(spark, posts, ["India"], str(tmp_path / "kept"), str(tmp_path / "s3"), 4,
                     trigger=None)
    assert got(keyed_table.read_table(spark, str(tmp_path / "kept"))) == \
        [(1, "about India", "today")]


def test_publish_lines_feeds_the_landing_folder(spark, landing, tmp_path):
    target = str(tmp_path / "published")
    sinks.publish_lines(spark, landing, target)
    sinks.publish_lines(spark, f"{landing}/0.txt", target)
    assert read_lines(spark, target).count() == 10
    assert len(glob.glob(f"{target}/*.txt")) >= 2


def test_preview(spark, capsys):
    head = sinks.preview(spark.range(30), 10, schema=True)
    assert head.count() == 10 and "id: long" in capsys.readouterr().out


def test_repeated_keys_in_a_file_in_two_files_and_delivered_twice(spark, tmp_path):
    folder, table = tmp_path / "vm", str(tmp_path / "table")
    folder.mkdir()

    def vm(cach, st):
        return " " + "  ".join([*map(str, range(1, 6)), str(cach), *map(str, range(7, 17)), str(st)])

    def take(state):
        jobs.vmstat_stream_to_table(spark, stream_lines(spark, str(folder)), table,
                                    str(tmp_path / state), 4, trigger=None)
        return {r["CACH"]: r["ST"] for r in keyed_table.read_table(spark, table).collect()}

    (folder / "b.txt").write_text("\n".join([vm(6, "old"), vm(6, "new"), vm(7, "x"), vm(7, "x")]))
    assert take("s1") == {"6": "new", "7": "x"}
    time.sleep(1.1)
    (folder / "a.txt").write_text("\n".join([vm(7, "y"), vm(8, "z")]))
    assert take("s1") == {"6": "new", "7": "y", "8": "z"}
    assert take("s1") == {"6": "new", "7": "y", "8": "z"}
    assert take("s2") == {"6": "new", "7": "y", "8": "z"}  # a new stream counts batches anew


def test_two_streams_share_an_alert_folder(spark, landing, tmp_path):
    out = str(tmp_path / "alerts")
    for state in ("s1", "s2"):
        jobs.alert_stream(stream(spark, landing), out, str(tmp_path / state), trigger=None)
    assert spark.read.csv(out).count() == 8
    jobs.alert_stream(stream(spark, landing), out, str(tmp_path / "s1"), trigger=None)
    assert spark.read.csv(out).count() == 8


def test_posts_keep_their_order_and_give_back_long_ones(spark, tmp_path):
    rows = spark.createDataFrame([(1, "first", "t", 1), (1, "second", "t", 2), (2, "x" * 300, "t", 3)],
                                 "id long, text string, created_at string, seq long")
    table = str(tmp_path / "posts")
    assert jobs.posts_to_table(spark, rows, table, 4, seq="seq") is None
    assert [r[1][:6] for r in got(keyed_table.read_table(spark, table))] == ["second", "xxxxxx"]
    short = str(tmp_path / "short")
    left = jobs.posts_to_table(spark, rows, short, 4, 200, "reject", seq="seq")
    assert [r["tweet_id"] for r in left.collect()] == [2]
    assert [r[0] for r in got(keyed_table.read_table(spark, short))] == [1]


def test_null_fields_keep_their_place_in_alert_lines(spark, tmp_path):
    row = spark.createDataFrame([("R1", None, "t", 1.0, None, 1.0, 1.0, 1.0, 1.0)], schemas.SENSOR)
    sinks.append_alerts(row, str(tmp_path / "a"), 0, "text")
    assert spark.read.text(str(tmp_path / "a")).first()[0] == "Sensor(R1,null,t,1.0,null,1.0,1.0,1.0,1.0)"


def test_store_options():
    assert sinks.store_options("cassandra", "t", "k", ttl=5) == (
        "org.apache.spark.sql.cassandra", {"table": "t", "keyspace": "k", "ttl": "5"})
    assert sinks.store_options("phoenix", "t")[1] == {"table": "t"}
    for bad in (("cassandra", "t"), ("other", "t")):
        with pytest.raises(ValueError):
            sinks.store_options(*bad)


def test_input_of_many_splits_is_not_shuffled(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "three"))
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    conf = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        three, one = (widen(spark.read.parquet(str(tmp_path / n))) for n in ("three", "one"))
        assert "Exchange" not in three._jdf.queryExecution().toString()
        assert "Exchange" in one._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", conf)
