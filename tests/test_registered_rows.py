"""Every registered query without an oracle runs on sf0.001 and returns a
stable, non-empty schema (the driver's rows-only check)."""

import pytest

from conftest import SF001


def _keys():
    import __spark_entry__ as e
    return sorted(set(e.queries()) - set(e.oracle_sql()))


@pytest.mark.parametrize("name", _keys())
def test_rows_only_query_runs(spark, name):
    import __spark_entry__ as e
    df = e.queries()[name](spark, SF001)
    rows = df.collect()
    assert df.columns and rows
    again = e.queries()[name](spark, SF001)
    assert again.schema == df.schema
