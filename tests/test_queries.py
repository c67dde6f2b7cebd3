"""Every query of the core that has SQL against DuckDB, over the smallest tables."""

import os

import pytest

from phyllo.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, name):
    pytest.importorskip("duckdb")
    import oracle

    assert oracle.compare(spark, DATA, name, registry).startswith("ok")


def test_every_query_runs(spark):
    for name in sorted(registry.queries().keys() - registry.oracle_sql().keys()):
        assert registry.queries()[name](spark, DATA).columns
