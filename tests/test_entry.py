import os

import pytest

import __spark_entry__ as e


def test_every_sql_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(e.SMOKE), reason="no test data")
def test_flagship(spark):
    df = e.entry(spark)
    assert df.columns == ["representative", "member"] and df.count() > 0
