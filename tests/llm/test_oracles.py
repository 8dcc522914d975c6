"""The queries that SQL can express, against their SQL."""

import pytest
from compare import same_rows

from tailframe.llm import queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, sf_dir, name):
    same_rows(queries.queries()[name](spark, sf_dir), queries.oracle_sql()[name], sf_dir)
