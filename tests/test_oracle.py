"""Every registered query against its DuckDB oracle SQL, and the Spark-side
derivation of the input tables against the SQL-side one, on sf0.001."""

from __future__ import annotations

import os

import pytest

from tools.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _names():
    from packlift import registry

    return sorted(registry.queries())


def test_every_query_has_oracle_sql():
    from packlift.checks import oracle

    assert set(_names()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E

    sdf = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [x[0] for x in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, res.fetchall())


DERIVED = {"sale": "m_sale", "sku": "m_sku", "common_sku": "m_common_sku", "promo": "m_promo", "lnk": "m_lnk",
           "exc": "m_exc", "price": "m_price", "result": "m_result", "client": "m_client",
           "promo_type": "m_type", "entity": "m_entity"}


@pytest.mark.parametrize("table", sorted(DERIVED))
def test_derivation_matches_sql(spark, con, table):
    from packlift.checks.derived_sql import with_derived
    from packlift.sources.tpch import load_tpch

    for stored in (False, True):
        df = getattr(load_tpch(spark, SF, stored=stored), table)
        cols = [c for c in df.columns if c != "op_year"]
        res = con.execute(with_derived(f"SELECT {', '.join(cols)} FROM {DERIVED[table]}"))
        assert rows_of(cols, [tuple(r) for r in df.select(*cols).collect()]) == rows_of(cols, res.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 21
