"""Every query of the subpackage against its SQL on whole tables."""

import os

import pytest
from comparing import rows_of, rows_of_sql

from siftmill.llm import oracle, queries
from siftmill.llm.tokens import default_vocabulary


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_same_rows_as_sql(spark, folder, database, name):
    if name.startswith("p8") and not os.path.exists(default_vocabulary()):
        pytest.skip("no vocabulary here")
    assert rows_of(queries.QUERIES[name](spark, folder)) == rows_of_sql(database, oracle.ORACLE[name])


def test_every_sql_has_a_query():
    assert set(oracle.ORACLE) <= set(queries.QUERIES)
