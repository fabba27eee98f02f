"""Every registered query against its DuckDB oracle on the smallest fixture."""
import pytest

from basketry.oracle.harness import compare
from basketry.registry import ORACLES, QUERIES, load_all

from .conftest import SMALL

load_all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    if name not in ORACLES:
        assert df.count() >= 0
        return
    ok, msg = compare(df, duck, ORACLES[name])
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_most_queries_have_oracles():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert len(missing) <= 5, missing
