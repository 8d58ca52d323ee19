"""Every query with SQL gives the SQL's rows; the others give rows."""

import oracle
import pytest

from glossweave.plans import registry

#: Queries that find nothing at the smallest scale are held against their SQL at the next one.
SPARSE = {"confusion_pairs", "lookalike_co"}


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, con, name):
    if name in SPARSE:
        sf = "/root/testdata/sf0.01"
        con = oracle.connect(sf)
    df = registry.QUERIES[name](spark, sf)
    if name in registry.SQL:
        assert oracle.differences(df, con, registry.SQL[name]) is None
    else:
        assert df.columns and df.count() > 0


def test_no_query_hides_another():
    """A second query of a name took the place of the first."""
    from glossweave.plans import base, derive

    assert registry.QUERIES["preposition_index"] is derive.preposition_index and "preposition_lines" in registry.QUERIES
    with pytest.raises(ValueError):
        base.query()(derive.preposition_index)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
