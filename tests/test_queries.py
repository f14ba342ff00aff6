"""Every query of the engine beside its SQL, on the smallest tables."""

import pytest

from tests.compare import compare, connect
from umbra.plans import catalogue


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n != "d12_doc_classifier"])
def test_query(spark, sf, duck, name):
    said, _ = compare(spark, duck, sf, name, catalogue.QUERIES[name], catalogue.SQL.get(name))
    assert said.startswith(("same", "rows only")), said


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 200
