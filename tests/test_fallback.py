"""The shuffle paths: with every broadcast refused, every query still matches
the oracle, and the exception join of the promo report runs on groups
pre-aggregated to (pair, TIN, sale date)."""

from __future__ import annotations

import os

import pytest

from tools.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")

def _names():
    from packlift import registry

    return sorted(registry.queries())


@pytest.fixture()
def no_broadcast(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for s in settings:
        spark.conf.set(s, "-1")
    yield spark
    for s in settings:
        spark.conf.unset(s)


@pytest.mark.parametrize("name", _names())
def test_shuffle_path_matches_oracle(no_broadcast, name):
    import __spark_entry__ as E

    spark = no_broadcast
    sdf = E.queries()[name](spark, SF)
    res = duck(SF).execute(E.oracle_sql()[name])
    dcols = [x[0] for x in res.description]
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, res.fetchall())


def test_exception_join_on_pre_aggregated_groups(no_broadcast):
    from packlift.plans import report as R
    from packlift.sources.tpch import load_tpch

    df = R.report_pivot(load_tpch(no_broadcast, SF))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    # the exception join's sales side is a final aggregate keyed by (pair, TIN, sale date)
    lines = plan.splitlines()
    join = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln and "tin_buyer" in ln and "LeftOuter" in ln)
    below = "\n".join(lines[join:join + 12])
    assert "HashAggregate(keys=[id_promotion" in below and "operation_date" in below


def test_groups_carry_the_sums_of_one_window(no_broadcast):
    """The groups that are shuffled to the exception join hold three sums per kind, not per sales type,
    and no sale of quantity 0."""
    from packlift.plans import report as R
    from packlift.sources.tpch import load_tpch

    plan = R.report_pivot(load_tpch(no_broadcast, SF))._jdf.queryExecution().optimizedPlan().toString()
    groups = next(ln for ln in plan.splitlines() if "Aggregate [id_promotion" in ln and "operation_date" in ln)
    assert groups.count("sum(") == 6, groups
    assert any("Filter" in ln and "NOT (quantity" in ln for ln in plan.splitlines())


def test_prices_are_joined_before_names_repeat_the_rows(no_broadcast):
    from packlift.plans import report as R
    from packlift.sources.tpch import load_tpch

    df = R.report_new(load_tpch(no_broadcast, SF))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [ln for ln in plan.splitlines() if "Join LeftOuter" in ln]
    assert "id_common_sku" in joins[0] and "start_date" in joins[3], joins[:4]
