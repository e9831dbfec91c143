"""Every registered query against its SQL, at two scales."""

import pytest

import __spark_entry__ as registry
from tests.parity import duck, duck_rows, spark_rows

QUERIES = {name: registry.queries()[name] for name in registry.base_queries()}
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def scale(request):
    folder = f"/root/testdata/{request.param}"
    return folder, duck(folder)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES)
    assert set(ORACLES) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, scale, name):
    folder, connection = scale
    assert spark_rows(QUERIES[name](spark, folder)) == duck_rows(connection, ORACLES[name])


def test_entry(spark):
    assert registry.entry(spark).count() == 13
