import __spark_entry__
import pytest
from oracle import compare

from voxloom.plans.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, name):
    compare(spark, sf, QUERIES[name], SQL[name])


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["file_id", "gap_start_ms", "gap_end_ms"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
