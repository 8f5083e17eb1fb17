import pytest
from oracle_check import compare, connect

from tidegauge.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, queries.queries()[name],
                   queries.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["op1_licences", "op3_quality_rules", "op5_main_text",
                                  "op9_sharding"])
def test_query_has_a_row_for_each_input(spark, name):
    rows = queries.queries()[name](spark, SF_DIR)
    table = "pages" if name == "op5_main_text" else "documents"
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
