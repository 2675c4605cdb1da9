"""Properties.

On the derived test tables: the two-stage buyer count equals a direct
``countDistinct``; the one-pass combined rows equal the two-branch union; the
grouped reconciliation equals the by-TIN one summed over TIN.

On random hand fixtures (hypothesis): the promo report's measures equal a
brute-force evaluation of the report's definition in plain Python.
"""

from __future__ import annotations

import os
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from packlift.operators import measures as M
from packlift.operators.pairs import PAIR_KEYS
from packlift.plans import reconcile as C
from packlift.plans import report as R
from packlift.rules import REPORT_RULES
from packlift.sources.tpch import load_tpch
from tests.fixtures import Rows, q

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def tables(spark):
    return load_tpch(spark, SF)


@needs_data
def test_two_stage_count_equals_count_distinct(tables):
    packs = R.sales_packs(R.combined_sales(R.flagged_sales(tables)))
    direct = (packs.where(F.col("sales_quantity") != 0)
              .groupBy("sales_type", *PAIR_KEYS)
              .agg(F.sum("sales_quantity").alias("sales_quantity"), F.sum("sales_pack").alias("sales_pack"),
                   F.count_distinct("tin_buyer").alias("acb")))
    two_stage = R.sales_type_agg(tables)
    cols = ["sales_type", *PAIR_KEYS, "sales_quantity", "sales_pack", "acb"]
    assert sorted(map(tuple, direct.select(*cols).collect()), key=repr) == sorted(map(tuple, two_stage.select(*cols).collect()), key=repr)


@needs_data
def test_one_pass_equals_two_branch_union(tables):
    flagged = R.flagged_sales(tables)
    one_pass = R.combined_sales(flagged)
    cond = R.conditional_sales(flagged).withColumn(
        "sales_type", F.when(F.col("in_promo"), "promo").otherwise("control"))
    total = flagged.withColumn("sales_type", F.when(F.col("in_promo"), "total_promo").otherwise("total_control"))
    cols = one_pass.columns
    union = cond.select(*cols).unionByName(total.select(*cols))
    assert sorted(map(tuple, one_pass.collect()), key=repr) == sorted(map(tuple, union.collect()), key=repr)


@needs_data
def test_grouped_equals_by_tin_summed(tables):
    by_tin = (C.sold_by_tin(tables).groupBy(*C.GROUP_KEYS, "bonus", "multiple")
              .agg(F.sum("quantity").alias("quantity"), F.sum("sum_bonus").alias("sum_bonus")))
    grouped = C.sold_grouped(tables)
    cols = [*C.GROUP_KEYS, "bonus", "multiple", "quantity", "sum_bonus"]
    assert sorted(map(tuple, by_tin.select(*cols).collect()), key=repr) == sorted(map(tuple, grouped.select(*cols).collect()), key=repr)


@needs_data
def test_totals_cover_qualifying_sales_without_exceptions(tables):
    from dataclasses import replace

    no_exc = replace(tables, exc=tables.exc.limit(0))
    p = R.report_pivot(no_exc).collect()
    for r in p:
        if r["sales_quantity_promo"] is not None and r["sales_quantity_promo"] > 0:
            assert r["total_sales"] is not None


# --- random fixtures against a brute-force evaluation --------------------------

BASE = date(2024, 1, 1)


def brute_force(rows: Rows) -> dict:
    """The promo report's pivot, straight from its definition: two branches,
    an exception test per conditional row, scored quantities, packs, distinct
    buyers per sales type."""
    sku_cs = {s: c for s, c, _ in rows.sku}
    live_promo = {p[0]: p for p in rows.promo if p[5] is None}
    pairs = [(pid, live_promo[pid][1], cs, live_promo[pid][2], live_promo[pid][3], live_promo[pid][4])
             for pid, cs, deleted in rows.lnk if deleted is None and pid in live_promo]
    groups = defaultdict(lambda: {"q": Decimal(0), "p": 0, "tins": set(), "n": 0})
    for pid, typ, cs, client, start, end in pairs:
        m = typ + 2
        ctrl_lo = start - (end - start)
        ctrl_hi = start - timedelta(days=1)
        for sku, cl, tin, day, qty, op, deleted in rows.sale:
            if deleted != date(2000, 1, 1) or cl not in REPORT_RULES.clients:
                continue
            if cl != client or sku_cs.get(sku) != cs:
                continue
            in_promo = start <= day <= end
            in_ctrl = ctrl_lo <= day <= ctrl_hi
            if not (in_promo or in_ctrl):
                continue
            branches = [("total_promo" if in_promo else "total_control", qty)]
            if op == 4:
                excluded = any(
                    e_cl == cl and tin is not None and e_tin == tin and sku_cs.get(e_sku) == cs
                    and (e_start <= day <= e_end or in_ctrl)
                    for e_cl, e_sku, e_tin, e_start, e_end in rows.exc)
                if not excluded:
                    if cl in (36, 37):
                        scored = qty if qty % m == 0 else Decimal(0)
                    else:
                        scored = qty if qty >= m else Decimal(0)
                    branches.append(("promo" if in_promo else "control", scored))
            for label, value in branches:
                if value == 0:
                    continue
                g = groups[(pid, label)]
                g["q"] += value
                g["p"] += int(value / m)
                g["n"] += 1
                if tin is not None:
                    g["tins"].add(tin)
    out = {}
    for (pid, label), g in groups.items():
        qn, pn, an = M.PIVOT_NAMES[label]
        row = out.setdefault(pid, {})
        row[qn], row[pn], row[an] = g["q"], g["p"], len(g["tins"])
    return out


sale_st = st.tuples(
    st.sampled_from([10, 11, 20]),                 # sku (20 is another common SKU)
    st.sampled_from([16, 36, 28, 99]),             # client
    st.sampled_from([None, 1, 2, 3]),              # tin
    st.integers(0, 45),                            # day offset
    st.integers(-7, 9),                            # quantity
    st.sampled_from([3, 4, 4]),                    # operation type
    st.sampled_from([False, False, False, True]),  # deleted
)
exc_st = st.tuples(st.sampled_from([16, 36]), st.sampled_from([10, 11]), st.sampled_from([None, 1, 2]),
                   st.integers(0, 45), st.integers(0, 20))
promo_st = st.tuples(st.sampled_from([16, 36, 28]), st.integers(0, 3), st.integers(5, 35), st.integers(-2, 12))


@needs_data
@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sales=st.lists(sale_st, max_size=25), excs=st.lists(exc_st, max_size=4),
       promos=st.lists(promo_st, min_size=1, max_size=3))
def test_report_equals_brute_force(spark, sales, excs, promos):
    rows = Rows(promo=[], lnk=[], exc=[])
    for i, (client, typ, start_off, length) in enumerate(promos, start=1):
        start = BASE + timedelta(days=start_off)
        rows.promo.append((i, typ, client, start, start + timedelta(days=length), None))
        rows.lnk.append((i, 1, None))
    for sku, client, tin, off, qty, op, deleted in sales:
        rows.sell(None if tin is None else 7700000000 + tin, BASE + timedelta(days=off), qty,
                  sku=sku, client=client, op=op, deleted=deleted)
    for client, sku, tin, off, length in excs:
        rows.exc.append((client, sku, None if tin is None else 7700000000 + tin,
                         BASE + timedelta(days=off), BASE + timedelta(days=off + length)))
    want = brute_force(rows)
    got = {}
    for r in R.report_pivot(rows.tables(spark)).collect():
        got[r["id_promotion"]] = {k: r[k] for names in M.PIVOT_NAMES.values() for k in names
                                  if r[k] is not None}
    assert got == {pid: {k: (q(v) if isinstance(v, Decimal) else v) for k, v in row.items()}
                   for pid, row in want.items()}
