import struct

import pytest
from pyspark.sql import functions as F

from tidegauge import schemas
from tidegauge.operators import cells
from tidegauge.operators.parse import parse_sensor
from tidegauge.sources.clustered import drop_clustered, write_clustered

LOW = ("R1", "2024-01-01", "00:00:01", 1.0, 2.5, 3.0, 4.0, 4.99, 6.0)
HIGH = ("R2", "2024-01-01", "00:00:02", 1e10, -0.0, 3.0, 4.0, 5.0, 6.0)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([LOW, HIGH], schemas.SENSOR)


def keyed(df):
    return {(r["row_key"], r["family"], r["qualifier"]): r["value"] for r in df.collect()}


def test_route_both(rows):
    got = keyed(cells.route(rows, "both"))
    assert len(got) == 17
    assert got["R1_2024-01-01 00:00:01", "alert", "psi"] == "4.99"
    assert got["R1_2024-01-01 00:00:01", "data", "psi"] == "4.99"
    assert got["R2_2024-01-01 00:00:02", "data", "hz"] == "1.0E10"
    assert got["R2_2024-01-01 00:00:02", "data", "resid"] == "R2"


def test_route_exclusive(spark, rows):
    got = keyed(cells.route(rows, "exclusive"))
    assert [k for k in got if k[0].startswith("R1")] == \
        [("R1_2024-01-01 00:00:01", "alert", "psi")]
    assert len(got) == 7
    nan = spark.createDataFrame([LOW[:7] + (float("nan"), 6.0)], schemas.SENSOR)
    assert {k[1] for k in keyed(cells.route(nan, "exclusive"))} == {"data"}


def test_names_rename_qualifiers(rows):
    got = keyed(cells.route(rows, "both", names={"resid": "resID"}))
    assert ("R1_2024-01-01 00:00:01", "data", "resID") in got


def test_null_has_no_cell(spark):
    df = spark.sql("select 1L emp_no, cast(null as string) last_name")
    got = keyed(cells.encode_cells(df, cells.employee_key()))
    assert got == {("1", "data", "emp_no"): "1"}


def test_binary_is_big_endian(rows):
    got = keyed(cells.route(rows, "both", "binary"))
    for row in (LOW, HIGH):
        key = f"{row[0]}_{row[1]} {row[2]}"
        for name, value in zip(schemas.METRICS, row[3:]):
            assert bytes(got[key, "data", name]) == struct.pack(">d", value)
    assert len(got) == 13


@pytest.mark.parametrize("encoding", ["text", "binary"])
def test_round_trip(rows, encoding):
    coded = cells.encode_cells(rows, cells.sensor_key(), cells.SENSOR_TEXT, encoding=encoding)
    back = sorted(tuple(r) for r in cells.decode_cells(coded, encoding).collect())
    assert back == [(f"{r[0]}_{r[1]} {r[2]}", r[0], r[1], *r[3:]) for r in (LOW, HIGH)]


def stored(spark, *found):
    return spark.createDataFrame([("k", *c) for c in found], schemas.CELL)


def test_missing_cells_have_defaults(spark):
    row = cells.decode_cells(stored(spark, ("data", "hz", "7"), ("data", "other", "x"))).first()
    assert tuple(row) == ("k", "", "", 7.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_data_wins_over_alert(spark):
    both = stored(spark, ("data", "psi", "2"), ("alert", "psi", "1"))
    assert cells.decode_cells(both).first()["psi"] == 2.0


def test_later_write_wins_within_a_family(spark):
    both = stored(spark, ("data", "psi", "2"), ("data", "psi", "1")).withColumn(
        "seq", F.when(F.col("value") == "1", 9).otherwise(3))
    assert cells.decode_cells(both).first()["psi"] == 1.0


def test_bad_number_fails(spark):
    with pytest.raises(Exception, match="bad cell"):
        cells.decode_cells(stored(spark, ("data", "psi", "low"))).collect()
    short = stored(spark, ("data", "psi", "low")).withColumn("value", F.encode("value", "UTF-8"))
    with pytest.raises(Exception):
        cells.decode_cells(short, "binary").collect()


def test_project_family(spark):
    df = cells.project_family(
        stored(spark, ("data", "flo", "1"), ("alert", "chlPPM", "2"), ("data", "chlPPM", "3")),
        "data", ["chlPPM", "flo"])
    assert df.columns == ["chlPPM", "flo"] and [tuple(r) for r in df.collect()] == [("3", "1")]


def test_input_is_parsed_once(spark, tmp_path):
    """One scan and one parse, whatever the number of families."""
    path = str(tmp_path / "in")
    spark.createDataFrame([(",".join(map(str, LOW)),)], "value string").write.text(path)
    plan = cells.route(parse_sensor(spark.read.text(path)))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("FileScan") == 1 and "Exchange" not in physical


def test_cells_stored_by_key_are_decoded_without_shuffle(spark, rows):
    written = cells.route(rows, "both")
    name = write_clustered(written, "row_key", 4)
    decoded = cells.decode_cells(spark.table(name))
    assert sorted(map(tuple, decoded.collect())) == sorted(
        map(tuple, cells.decode_cells(written).collect()))
    assert "Exchange" not in decoded._jdf.queryExecution().executedPlan().toString()
    drop_clustered(spark, name)
