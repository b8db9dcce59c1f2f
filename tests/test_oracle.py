"""Every registered query against its SQL twin on DuckDB (sf0.001); queries
without SQL must at least run. The driver repeats this at sf0.01."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

@pytest.fixture(scope="module")
def duck():
    import oracle_check
    return oracle_check


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    res = duck.compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res == "ok" or res.startswith("rows-only"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "channel_id" in df.columns
