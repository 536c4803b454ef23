"""Every query of the mapped and raw ingest equals its DuckDB oracle on the
smallest tables."""
import pytest

import __spark_entry__ as E
from compare import compare, duck
from conftest import SF_SMALL
from feedloom.plans.catalog import REGISTRY
from feedloom.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(REGISTRY[name](spark, SF_SMALL), con, ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "inventory_partno" in df.columns
