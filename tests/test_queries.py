"""Every core query against its SQL on whole tables."""

import pytest
from comparing import rows_of, rows_of_sql

from siftmill import oracle, queries


#: The smallest tables hold too few docked ligands to train on; tests of the loop are in test_plans.
TOO_SMALL = {"active_rounds"}


@pytest.mark.parametrize("name", sorted(set(oracle.ORACLE) - TOO_SMALL))
def test_same_rows_as_sql(spark, folder, database, name):
    assert rows_of(queries.QUERIES[name](spark, folder)) == rows_of_sql(database, oracle.ORACLE[name])


def test_every_sql_has_a_query():
    assert set(oracle.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", ["blake3_shard_counts", "file_listing"])
def test_runs(spark, folder, name):
    assert queries.QUERIES[name](spark, folder).count() > 0


def test_entry(spark, folder):
    import __spark_entry__

    assert set(__spark_entry__.entry(spark).columns) == {"vec_no", "shard_id", "selection_group"}
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
