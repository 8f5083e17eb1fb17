import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import schemas
from tidegauge.operators import cells, keyed_table
from tidegauge.sources import files

SCHEMA = "k long, a string, b string"


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.createDataFrame([], SCHEMA).schema
    assert keyed_table.ensure_table(spark, path, schema, ["k"], buckets=4)
    return path


def rows(spark, *data):
    return spark.createDataFrame(data, SCHEMA + ", seq int")


def content(spark, path):
    return sorted(tuple(r) for r in keyed_table.read_table(spark, path).collect())


def test_create_is_idempotent(spark, table):
    keyed_table.upsert(spark, table, rows(spark, (1, "x", "y", 1)))
    there = keyed_table._table(spark, table)
    assert not keyed_table.ensure_table(spark, table, keyed_table._schema(there), ["k"], 4)
    assert content(spark, table) == [(1, "x", "y")]


def test_empty_table(spark, table):
    assert content(spark, table) == []
    assert keyed_table.read_table(spark, table, ["b"]).columns == ["b"]


def test_latest_in_batch_and_across_batches(spark, table):
    keyed_table.upsert(spark, table, rows(spark, (1, "p", "q", 9), (1, "r", "s", 2),
                                          (2, "t", "u", 1)), seq="seq")
    assert content(spark, table) == [(1, "p", "q"), (2, "t", "u")]
    keyed_table.upsert(spark, table, rows(spark, (1, "new", None, 1)), seq="seq")
    assert content(spark, table) == [(1, "new", None), (2, "t", "u")]
    assert [r[0] for r in keyed_table.read_table(spark, table, ["a"]).orderBy("a").collect()] \
        == ["new", "t"]


def test_twice_is_once(spark, table):
    batch = rows(spark, (1, "p", "q", 1), (2, "r", "s", 1))
    keyed_table.upsert(spark, table, batch)
    once = content(spark, table)
    keyed_table.upsert(spark, table, batch)
    assert content(spark, table) == once


def test_duplicate_and_null_keys_fail(spark, table):
    with pytest.raises(Exception, match="written twice"):
        keyed_table.upsert(spark, table, rows(spark, (1, "p", "q", 1), (1, "r", "s", 1)))
    with pytest.raises(Exception, match="null in key"):
        keyed_table.upsert(spark, table, rows(spark, (None, "p", "q", 1)))
    assert content(spark, table) == []


def test_subset_keeps_other_columns(spark, table):
    keyed_table.upsert(spark, table, rows(spark, (1, "p", "q", 1), (2, "r", "s", 1)))
    keyed_table.upsert(spark, table, rows(spark, (1, None, "-", 1), (3, "n", "-", 1)),
                       columns=["k", "a"])
    assert content(spark, table) == [(1, None, "q"), (2, "r", "s"), (3, "n", None)]


def test_replayed_batch_is_skipped(spark, table):
    assert keyed_table.upsert(spark, table, rows(spark, (1, "p", "q", 1)), batch_id=0)
    assert not keyed_table.upsert(spark, table, rows(spark, (1, "z", "z", 1)), batch_id=0)
    assert keyed_table.upsert(spark, table, rows(spark, (2, "z", "z", 1)), batch_id=0,
                              stream="other")
    assert content(spark, table) == [(1, "p", "q"), (2, "z", "z")]


def test_many_writes_keep_the_newest(spark, table):
    for i in range(5):
        batch = spark.range(20).select(F.col("id").alias("k"), F.lit(f"a{i}").alias("a"),
                                       F.lit(f"b{i}").alias("b")).filter(F.col("k") >= 3 * i)
        keyed_table.upsert(spark, table, batch)
    expected = [(k, f"a{min(k // 3, 4)}", f"b{min(k // 3, 4)}") for k in range(20)]
    assert content(spark, table) == expected
    assert len(files.names(spark, f"{table}/_done")) == 1
    assert [n for n in os.listdir(table) if n.startswith("_next") or n == "_writing.json"] == []


def stamps(table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table}/data/*/*.parquet")}


def test_untouched_buckets_are_not_rewritten(spark, table):
    keyed_table.upsert(spark, table, spark.range(40).selectExpr("id k", "'a' a", "'b' b"))
    before = stamps(table)
    keyed_table.upsert(spark, table, rows(spark, (1, "n", "n", 1)))
    after = stamps(table)
    gone = {f.rsplit("/", 2)[1] for f in before if after.get(f) != before[f]}
    assert len(gone) == 1 and len(content(spark, table)) == 40


def test_the_table_is_read_without_shuffle(spark, table):
    keyed_table.upsert(spark, table, rows(spark, (1, "p", "q", 1)))
    keyed_table.upsert(spark, table, rows(spark, (1, "r", "q", 1)))
    plan = keyed_table.read_table(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_second_writer_fails(spark, table, monkeypatch):
    united = keyed_table._united

    def meanwhile(*args):
        monkeypatch.setattr(keyed_table, "_united", united)
        keyed_table.upsert(spark, table, rows(spark, (1, "first", "q", 1)))
        return united(*args)

    monkeypatch.setattr(keyed_table, "_united", meanwhile)
    with pytest.raises(keyed_table.TableChanged):
        keyed_table.upsert(spark, table, rows(spark, (1, "late", "q", 1)))
    assert content(spark, table) == [(1, "first", "q")]
    keyed_table.upsert(spark, table, rows(spark, (1, "again", "q", 1)))
    assert content(spark, table) == [(1, "again", "q")]


@pytest.mark.parametrize("where", ["before", "after"])
def test_a_writer_that_dies_is_finished(spark, table, monkeypatch, where):
    keyed_table.upsert(spark, table, rows(spark, (1, "p", "q", 1), (3, "x", "y", 1)))

    class Died(Exception):
        pass

    def die(spark, path, text_or_table, *rest):
        if where == "after" and "/_done/" not in path:
            return create(spark, path, text_or_table)
        raise Died

    create = files.create_text
    if where == "before":  # the note is there, the data are not touched
        monkeypatch.setattr(keyed_table, "_put_in_place", die)
    else:  # the data are in place, the mark is not
        monkeypatch.setattr(files, "create_text", die)
    with pytest.raises(Died):
        keyed_table.upsert(spark, table, rows(spark, (1, "new", "q", 1)), batch_id=7)
    monkeypatch.undo()
    with pytest.raises(keyed_table.TableChanged):
        keyed_table.upsert(spark, table, rows(spark, (2, "r", "s", 1)))
    there = keyed_table._table(spark, table)
    keyed_table.ensure_table(spark, table, keyed_table._schema(there), ["k"], 4)
    assert content(spark, table) == [(1, "new", "q"), (3, "x", "y")]
    assert not keyed_table.upsert(spark, table, rows(spark, (1, "old", "q", 1)), batch_id=7)


def test_another_schema_or_key_at_that_place_is_an_error(spark, table):
    schema = keyed_table._schema(keyed_table._table(spark, table))
    assert not keyed_table.ensure_table(spark, table, schema, ["k"], 4)
    with pytest.raises(ValueError, match="other columns or keys"):
        keyed_table.ensure_table(spark, table, schema, ["a"], 4)
    with pytest.raises(ValueError, match="other columns or keys"):
        keyed_table.ensure_table(spark, table, schemas.CELL, schemas.CELL_KEYS, 4)


def test_a_write_reads_only_its_buckets(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "many")
    schema = spark.range(1).selectExpr("id k", "'a' a", "'b' b").schema
    keyed_table.ensure_table(spark, path, schema, ["k"], 16)
    keyed_table.upsert(spark, path, spark.range(200).selectExpr("id k", "'a' a", "'b' b"))
    asked = []
    stored = keyed_table._stored
    monkeypatch.setattr(keyed_table, "_stored", lambda *args: asked.append(stored(*args)) or asked[0])
    keyed_table.upsert(spark, path, spark.sql("select 7L k, 'new' a"), columns=["k", "a"])
    monkeypatch.undo()
    assert "PartitionFilters: []" not in asked[0]._jdf.queryExecution().executedPlan().toString()
    kept = keyed_table.read_table(spark, path)
    assert kept.filter("k = 7").collect()[0][1:] == ("new", "b") and kept.count() == 200


@pytest.mark.parametrize("on_long,expected", [
    ("truncate", [(1, "abc", "q"), (2, "ok", "q")]), ("reject", [(2, "ok", "q")])])
def test_text_length(spark, table, on_long, expected):
    batch = rows(spark, (1, "abcd", "q", 1), (2, "ok", "q", 1))
    with pytest.raises(Exception, match="longer than 3"):
        keyed_table.upsert(spark, table, batch, max_len={"a": 3})
    assert [r["k"] for r in keyed_table.too_long(batch, {"a": 3}).collect()] == [1]
    keyed_table.upsert(spark, table, batch, max_len={"a": 3}, on_long=on_long)
    assert content(spark, table) == expected


def test_head_is_ordered(spark, table):
    keyed_table.upsert(spark, table, spark.range(30).selectExpr("30 - id k", "'a' a", "'b' b"))
    assert [r["k"] for r in keyed_table.table_head(spark, table).collect()] == [1, 2, 3, 4, 5]
    assert keyed_table.table_head(spark, table, 3, ordered=False).count() == 3


def test_cells_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "cells")
    keyed_table.ensure_cells(spark, path, 4)

    def put(psi):
        row = ("R1", "2024-01-01", "00:00:01", 1.0, 2.0, 3.0, 4.0, psi, 6.0)
        df = spark.createDataFrame([row], schemas.SENSOR)
        keyed_table.write_cells(spark, path, cells.route(df, "both"))

    put(1.0)
    put(8.0)
    table = keyed_table.read_table(spark, path)
    assert table.count() == 9
    # The old alert stays, as nothing was written to that cell again.
    assert {r["family"]: r["value"] for r in table.filter("qualifier = 'psi'").collect()} == \
        {"alert": "1.0", "data": "8.0"}
    assert cells.decode_cells(table).first()["psi"] == 8.0


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_cells_are_grouped_where_their_rows_were_dealt(spark):
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SENSOR)
    rows = spark.createDataFrame([], f"{fields}, seq long")
    for dealt, key, made in ((rows, cells.sensor_key(), cells.route),
                             (spark.createDataFrame([], T.StructType([*schemas.VMSTAT_STAMPED, T.StructField("seq", T.LongType())])),
                              cells.vmstat_key(), cells.vmstat_cells)):
        found = made(cells.by_row(dealt, key)).select(*schemas.CELL.fieldNames(), "seq")
        assert exchanges(keyed_table._one_per_key(
            found, schemas.CELL_KEYS, "seq", schemas.CELL.fieldNames())) == 1


def test_a_write_shuffles_stored_and_new_rows_once(spark, tmp_path):
    path = str(tmp_path / "cells")
    keyed_table.ensure_cells(spark, path, 4)
    for value in ("old", "new"):
        keyed_table.write_cells(spark, path, spark.createDataFrame(
            [(f"r{i}", "data", "q", f"{value}{i}") for i in range(0 if value == "old" else 20, 40)], schemas.CELL))
    found = {r.row_key: r.value for r in keyed_table.read_table(spark, path).collect()}
    assert found == {f"r{i}": f"{'old' if i < 20 else 'new'}{i}" for i in range(40)}
    table = keyed_table._table(spark, path)
    stored = keyed_table._stored(spark, path, table, list(range(4)))
    united = keyed_table._united(stored, stored, table, schemas.CELL.fieldNames())
    assert exchanges(united) == 1 and "partial_max_by" in united._jdf.queryExecution().executedPlan(
        ).toString().split("Exchange")[0]
