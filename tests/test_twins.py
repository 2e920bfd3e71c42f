"""Every registered query against its SQL twin on the smallest data set."""

import pytest

from prepkit.queries import REGISTRY
from tests.twin import DATA, compare, oracle

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", [n for n, e in REGISTRY.items() if e.sql is not None])
def test_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) == []


def test_entry_has_rows_and_all_queries(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
