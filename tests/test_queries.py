"""Every registered query of the core against its SQL, on the smallest tables."""

import pytest
from compare import same_rows

import __spark_entry__ as entry
from tailframe.plans import oracle, queries


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, sf_dir, name):
    same_rows(queries.queries()[name](spark, sf_dir), oracle.oracle_sql()[name], sf_dir)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_lines_push_down_to_a_narrow_scan(spark, sf_dir):
    from tailframe.operators.lines import records

    chunks = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("source as instance_id", "lang as engine", "lang as log_file", "string(doc_id) as prev_marker", "string(doc_id + 1) as next_marker", "text as data")
    plan = records(chunks).where("instance_id = 'src1'").select("message", "batch_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EqualTo(source,src1)" in plan and "n_chars" not in plan
