"""Every registered query next to its SQL, and the driver contract."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect
from tutelage.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"h3_train_student"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ROWS_ONLY:
        assert name not in oracle_sql() and queries()[name](spark, SF).count() > 0
    else:
        assert compare(spark, con, SF, queries()[name], oracle_sql()[name]) is None
    spark.catalog.clearCache()


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["label", "precision", "recall", "f1", "support"] and df.count() == 6
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())
