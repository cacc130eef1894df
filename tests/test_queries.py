"""Every registered query against its SQL, and the entry points."""

import pytest
from oracle import connection, differences

import __spark_entry__
from tracemill.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    assert differences(catalog.QUERIES[name](spark, sf_dir), connection(sf_dir), catalog.SQL[name]) == ""


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
