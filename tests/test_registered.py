import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidegauge import schemas
from tidegauge.plans import catalog, oracle
from tidegauge.plans.avro_files import write_avro
from tidegauge.sources import read_employees

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def customers(spark, sf, rows):
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                          "c_mktsegment string").write.parquet(f"{sf}/customer.parquet")
    spark.createDataFrame([(1, "one", 0), (2, "two", 0)], "n_nationkey int, n_name string, n_regionkey int"
                          ).write.parquet(f"{sf}/nation.parquet")


def test_avro_numbers_beyond_int_and_null_names(spark, tmp_path):
    customers(spark, tmp_path, [(5_000_000_000, "Ann", 1, 0.0, "x"), (-3, None, 1, 0.0, None)])
    found = {r.emp_no: (r.first_name, r.last_name) for r in QUERIES["employees_avro"](
        spark, str(tmp_path)).collect()}
    assert found == {5_000_000_000: ("x", "Ann"), -3: (None, None)}


def avro_names(spark, sf):
    return {r.emp_no: r.last_name for r in QUERIES["employees_avro"](spark, str(sf)).collect()}


def test_avro_in_a_shared_folder_that_only_spark_reaches(spark, tmp_path, monkeypatch):
    customers(spark, tmp_path, [(1, "Ann", 1, 0.0, "x"), (2, "B\u00f6", 1, 0.0, None)])
    (tmp_path / "shared").mkdir()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(f"fs.viewfs.mounttable.{tmp_path.name}.link./shared", f"file://{tmp_path}/shared")
    monkeypatch.setattr(catalog, "scratch_dir", lambda _, label: f"viewfs://{tmp_path.name}/shared/{label}")
    assert avro_names(spark, tmp_path) == {1: "Ann", 2: "B\u00f6"}
    assert list(tmp_path.glob("shared/employees-avro/*.avro"))


def test_avro_on_a_cluster_without_the_package(spark, tmp_path, monkeypatch):
    customers(spark, tmp_path, [(1, "Ann", 1, 0.0, "x")])
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert avro_names(spark, tmp_path) == {1: "Ann"}


def test_avro_text_that_cannot_be_decoded(spark, tmp_path):
    customers(spark, tmp_path, [(1, "Ann", 1, 0.0, "x")])
    spoiled = spark.read.parquet(f"{tmp_path}/customer.parquet").withColumn(
        "c_name", F.unhex(F.lit("41FF42")).cast("string"))
    (tmp_path / "spoiled").mkdir()
    spoiled.write.parquet(f"{tmp_path}/spoiled/customer.parquet")
    assert avro_names(spark, tmp_path / "spoiled") == {1: "A\ufffdB"}


def test_avro_files_are_whole_and_split(spark, tmp_path):
    rows = spark.range(30_000, numPartitions=2).select(
        F.col("id").alias("emp_no"), *[F.concat(F.lit(f"{c}\n"), "id").alias(c)
                                       for c in schemas.EMPLOYEE.fieldNames()[1:]])
    write_avro(rows, str(tmp_path / "many"))
    write_avro(spark.createDataFrame([], rows.schema), str(tmp_path / "none"))
    many = read_employees(spark, str(tmp_path / "many"), "avro").select(rows.columns)
    assert many.exceptAll(rows).count() == rows.exceptAll(many).count() == 0
    assert read_employees(spark, str(tmp_path / "none"), "avro").count() == 0


def test_number_of_a_customer_and_a_supplier(spark, tmp_path):
    customers(spark, tmp_path, [(0, "Ann", 1, 0.0, "BUILDING"), (7, "Bob", 1, 0.0, "BUILDING")])
    spark.createDataFrame([(0, "S", 2, 0.0), (7, "T", 2, 0.0)], "s_suppkey long, s_name string, "
                          "s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    found = {r.emp_no: (r.first_name, r.last_name) for r in QUERIES["upsert_subset_columns"](
        spark, str(tmp_path)).collect()}
    assert found == {0: ("two", "Ann"), 7: ("one", "Bob"), -7: ("two", None)}
